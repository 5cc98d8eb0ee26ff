"""Column functions: logical types and typed coercion."""
