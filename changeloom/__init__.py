"""Change-data replication on Spark."""

from changeloom.options import ReplicationOptions
from changeloom.session import configure_session

__all__ = ["ReplicationOptions", "configure_session"]
