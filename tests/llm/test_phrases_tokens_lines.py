"""Collocations, tokenizer alignment and line dedup against brute force, on small tables with the awkward rows."""

import collections
import hashlib
import random
import re

import duckdb
import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from changeloom.llm import align, chunks, collocations, linededup, queries

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("chunk", "part", "body", "shard", "phrase", "words", "f", "n", "a", "b", "hi", "lo", "n_a", "id", "pos", "count", "best")


def with_clashes(df):
    for name in CLASHES:
        df = df.withColumn(name, F.lit("x"))
    return df


@pytest.fixture(scope="module")
def odd(spark):
    rnd = random.Random(3)
    vocabulary = ["alpha", "Beta", "new", "york", "city", "of", "é", "日本", "a.b", "x,y;z", "don't", "\x1c", " ", "\u0085"]
    lines = [" ".join(rnd.choices(vocabulary, k=rnd.randint(1, 12))) for _ in range(40)] + ["", "  ", "\tNew York  ", "new york", "NEW YORK\r", "É"]
    texts = ["\n".join(rnd.choices(lines, k=rnd.randint(1, 9))) for _ in range(120)]
    rows = [(i, text, rnd.choice(["en", "fr", None, "und"]), "a", 1) for i, text in enumerate(texts)]
    rows += [(200, None, "en", "a", None), (201, "", "fr", None, 0), (202, " \n\t ", None, "b", 4), (None, texts[0], "en", "a", 1), (3, texts[3], rows[3][2], "a", 1)]
    rows += [(203, "new york city " * 20_000, "en", "a", 1), (204, "\n".join(["New York"] * 5_000), "fr", "a", 1)]
    rows += [(205, "<|endoftext|> <s> </s> <0x41> <unk>", "en", "a", 1), (206, "▁a ▁▁ b", "en", "a", 1), (207, "  two  spaces　wide \n\n\n end  ", "en", "a", 1)]
    rows += [(208, "nul \x00 \x01 ᠎​ 👩‍👩‍👧 ﬁ ½ é", "en", "a", 1), (209, "x" * 3000 + "\r\n\r\n" + " " * 70, "en", "a", 1)]
    return with_clashes(spark.createDataFrame(rows, SCHEMA)).repartition(5)


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


def plain(df, *names):
    return sorted((tuple(row[n] for n in names) for row in df.collect()), key=str)


# --- 11 collocations ------------------------------------------------------------------------------------------


def pieces_of(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
        yield [w for w in re.split("[ \t]", piece) if w]


def brute_collocations(rows, support, top):
    counts, totals = collections.Counter(), collections.Counter()
    for row in rows:
        lang = row.lang or "und"
        for words in pieces_of(row.text):
            totals[lang] += len(words)
            counts.update((lang, tuple(words[i : i + m])) for m in (1, 2, 3, 4) for i in range(len(words) - m + 1))
    often = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= support}
    out = collections.defaultdict(list)
    for (lang, words), a in often.items():
        longer = [f for (other, w), f in often.items() if other == lang and len(w) > len(words) and any(w[i : i + len(words)] == words for i in range(len(w)))]
        if any(100 * f >= 80 * a for f in longer):
            continue
        score, _, left, right = min(
            (2_000_000 * a // (counts[lang, words[:k]] + counts[lang, words[k:]]), k, counts[lang, words[:k]], counts[lang, words[k:]]) for k in range(1, len(words))
        )
        phrase = " ".join(words)
        out[lang].append((-score, -a, phrase.encode(), (lang, phrase, a, left, right, totals[lang], score)))
    return sorted(((i + 1, *found[3]) for each in out.values() for i, found in enumerate(sorted(each)[:top])), key=str)


NAMES = ("rank", "lang", "phrase", "a", "l", "r", "n", "score")


@pytest.mark.parametrize(("support", "top", "shard", "table"), [(30, 2000, 1 << 20, 1 << 26), (3, 5, 1 << 20, 1 << 26), (5, 2000, 500, 64), (30, 2000, 200, 1 << 12)])
def test_collocations_match_brute_force(odd, support, top, shard, table):
    # many small shards lower the local support to one; a table of few bits lets other phrases be counted as well
    got = collocations.mine(odd, support=support, top=top, shard=shard, table=table)
    assert plain(got, *NAMES) == brute_collocations(odd.collect(), support, top) != []


def test_collocations_of_empty_tables(odd, none):
    assert collocations.mine(none).collect() == []
    assert collocations.mine(odd.where("text is null or text = ''")).collect() == []


def test_shards_lower_the_support_in_proportion(spark):
    rows = [("left right", "en")] * 40 + [(f"only{i} once{i}", "en") for i in range(400)]
    docs = spark.createDataFrame(rows, "text string, lang string").select("lang", "text").coalesce(1)
    total = sum(len(row[0]) for row in rows)
    shards = collocations.chunked(docs, "t", lambda: collocations._numbers, total // 5)
    # a fifth of the bytes: five or six times in a shard make a candidate, which only the phrase and its two words reach
    words = collocations.candidates(shards, total, 30, [])
    assert words.count() == 2
    tables = [collocations.candidate_table(words)]
    assert collocations.candidates(shards, total, 30, tables).count() == 1


# --- 12 alignment ---------------------------------------------------------------------------------------------


def brute_alignment(rows):
    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B)
    spelled_a, spelled_b = align.ByteLevel(A).token, align.Pieces(B).token
    docs, counts = [], collections.Counter()
    for row in rows:
        full = (" " + (row.text or "")).encode()
        a = first.encode(" " + row.text, add_special_tokens=False).ids if row.text else []
        b = second.encode(row.text) if row.text else []
        if not row.text or b"".join(spelled_a[i] for i in a) != full or b"".join(spelled_b[i] for i in b) != full:
            docs.append((row.doc_id, 0, 0, [], []))
            continue
        ends_a, ends_b = np.cumsum([len(spelled_a[i]) for i in a]).tolist(), np.cumsum([len(spelled_b[i]) for i in b]).tolist()
        # byte by byte: the tokens that hold it
        owner_a, owner_b = [i for i, t in enumerate(a) for _ in spelled_a[t]], [i for i, t in enumerate(b) for _ in spelled_b[t]]
        pairs = [(a[i], b[j]) for i, j in sorted(set(zip(owner_a, owner_b)))]
        groups, i, j = [], 0, 0
        for end in [e for e in ends_a if e in set(ends_b)]:
            m, n = ends_a.index(end) + 1, ends_b.index(end) + 1
            groups.append(f"{','.join(map(str, a[i:m]))}|{','.join(map(str, b[j:n]))}")
            i, j = m, n
        counts.update(pairs)
        docs.append((row.doc_id, len(a), len(b), groups, pairs))
    best = collections.Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return sorted(
        ((d, n_a, n_b, len(g), len(p), sum(counts[x] == best[x[1]] for x in p), sum(counts[x] for x in p), ";".join(g)) for d, n_a, n_b, g, p in docs), key=str
    )


@pytest.mark.parametrize("chunk", [align.CHUNK, 300])
def test_alignment_matches_brute_force(odd, chunk, monkeypatch):
    rows = odd.where("doc_id is null or doc_id not in (203, 204)")
    got = align.align(rows, A, B, chunk=chunk)
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    assert plain(got, *names) == brute_alignment(rows.collect())
    spread = got.where("n_groups > 0 and n_links > n_groups").count()
    assert spread > 50 and got.where("n_a = 0 and groups = ''").count() >= 3


def test_alignment_keeps_a_row_for_each_run(spark, monkeypatch):
    rnd = random.Random(3)
    texts = [" ".join("".join(rnd.choices("abcdefgh", k=rnd.randint(1, 9))) for _ in range(500)) for _ in range(800)]
    rows = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "doc_id long, text string").coalesce(1)
    kept, real = [], chunks.stored
    monkeypatch.setattr(chunks, "stored", lambda df, purpose, **options: kept.append(real(df, purpose, **options)) or kept[-1])
    got = plain(align.align(rows, A, B), "doc_id", "n_a", "n_links", "n_best", "count_sum", "groups")
    assert got == plain(align.align(rows, A, B, chunk=1000), "doc_id", "n_a", "n_links", "n_best", "count_sum", "groups")
    # one chunk, in runs of STEP characters; a run has fewer compressed bytes than characters
    runs = sorted(map(tuple, kept[0].select("chunk", "pos", F.length("body"), F.col("pairs").isNotNull()).collect()))
    size = sum(map(len, texts))
    assert len({chunk for chunk, *_ in runs}) == 1 and len(runs) >= size // align.STEP > 5
    assert [(pos, first) for _, pos, _, first in runs] == [(i, i == 0) for i in range(len(runs))]
    assert all(n < 2 * align.STEP for _, _, n, _ in runs)
    files = [pq.ParquetFile(name.removeprefix("file://").removeprefix("file:")).metadata for name in kept[0].inputFiles()]
    assert all(m.row_group(i).total_byte_size < 6 << 20 for m in files for i in range(m.num_row_groups))


def test_ranks_give_the_ids_of_the_tokenizer(spark, odd):
    texts = [r.text for r in odd.collect() if r.text] + [r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    rnd = random.Random(5)
    letters = "abcdeSTdmlvr'  \n\t019.,-_\u00e9\u00df\u0153\u2019\u20ac\u00d7"
    texts += ["".join(rnd.choices(letters, k=rnd.randint(1, 60))) for _ in range(3_000)]
    full = [" " + text for text in texts]
    model = align.ByteLevel(A)
    assert model.ranked and sum(not align._UNSURE(text) for text in full) > 3_500
    assert [ids for ids, _ in model.ids(full)] == model.whole(full)
    assert all(b''.join(model.token[i] for i in ids).decode() == text for text, (ids, sure) in zip(full, model.ids(full)) if sure)


def test_alignment_of_empty_and_very_long(odd, none):
    assert align.align(none, A, B).collect() == []
    long = align.align(odd.where("doc_id in (203, 204)"), A, B).collect()
    assert all(row.n_links >= row.n_groups > 5_000 for row in long)


def test_links_of_a_group_with_several_tokens_on_both_sides():
    ends_a, ends_b = np.array([2, 5, 6, 9]), np.array([1, 4, 6, 7, 8, 9])
    cut_a, cut_b = align.cuts(ends_a.tolist(), ends_b.tolist())
    assert (cut_a.tolist(), cut_b.tolist()) == ([3, 4], [3, 6])
    found = sorted(zip(*(x.tolist() for x in align.links(cut_a, cut_b, ends_a, ends_b))))
    assert found == [(0, 0), (0, 1), (1, 1), (1, 2), (2, 2), (3, 3), (3, 4), (3, 5)]


# --- 13 line dedup --------------------------------------------------------------------------------------------


def brute_lines(rows, min_docs, min_chars):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})

    docs = [(row.doc_id, (row.text or "").split("\n")) for row in rows]
    found = collections.Counter(k for _, lines in docs for k in {key(line) for line in lines})
    out = []
    for doc_id, lines in docs:
        kept = [line for line in lines if len(key(line)) < min_chars or found[key(line)] < min_docs]
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize(("min_docs", "min_chars", "shard", "chunk"), [(10, 1, 1 << 13, 1 << 22), (5, 0, 4, 200), (2, 6, 7, 1000), (20, 1, 1, 50)])
def test_lines_match_brute_force(odd, min_docs, min_chars, shard, chunk):
    got = linededup.dedup(odd, min_docs=min_docs, min_chars=min_chars, shard=shard, chunk=chunk)
    want = brute_lines(odd.collect(), min_docs, min_chars)
    assert plain(got, "doc_id", "n_lines", "n_dropped", "text") == want
    assert sum(row[2] for row in want) > 0


def test_lines_of_empty_tables(odd, none):
    assert linededup.dedup(none).collect() == []
    got = linededup.dedup(odd.where("text is null or text = ''")).collect()
    assert {(row.n_lines, row.n_dropped, row.text) for row in got} == {(1, 0, "")}


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 5_000])
def test_perfect_hash_is_minimal_and_knows_its_keys(n):
    keys = linededup.digests([f"key {i}".encode() for i in range(n)])
    built = linededup.PerfectHash(keys, np.arange(1, n + 1))
    assert sorted(built.index(keys).tolist()) == list(range(n))
    assert built.documents(keys).tolist() == list(range(1, n + 1))
    foreign = linededup.digests([f"other {i}".encode() for i in range(5_000)])
    assert not built.documents(foreign).any()
    # under five bits a key, apart from the first words of the levels
    assert sum(len(level) for level in built.bits) * 64 < 5 * n + 64 * len(built.bits)


def test_one_key_many_times_is_not_distinct():
    keys = np.repeat(linededup.digests([b"same"]), 2, axis=0)
    with pytest.raises(ValueError, match="distinct"):
        linededup.PerfectHash(keys, np.ones(2))


@pytest.mark.parametrize("name", ["op11_collocations", "op13_line_dedup"])
def test_sql_of_the_queries(spark, name):
    con = duckdb.connect()
    con.execute("create view documents as select * from '/root/testdata/sf0.01/documents.parquet'")
    want = con.execute(queries.SQL[name])
    names = [d[0] for d in want.description]
    got = queries.all_queries()[name](spark, "/root/testdata/sf0.01")
    assert sorted(got.columns) == sorted(names)
    assert plain(got, *names) == sorted(want.fetchall(), key=str) != []


def test_alignment_digest(spark):
    rows = queries.op12_alignment(spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 200 and all(re.fullmatch("[0-9a-f]{64}|", row.groups_sha256) for row in rows)
    found = {row.doc_id: row for row in align.align(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), A, B).collect()}
    for row in rows:
        assert row.groups_sha256 == (hashlib.sha256(found[row.doc_id].groups.encode()).hexdigest() if row.n_a else "")


def test_cuts_and_links_of_many_tokens_at_once():
    rng = np.random.default_rng(5)
    for _ in range(50):
        size = int(rng.integers(1, 60))
        ends_a, ends_b = (np.union1d(rng.integers(1, size + 1, int(rng.integers(1, 40))), [size]) for _ in "ab")
        cut_a, cut_b = align.cuts(ends_a, ends_b)
        assert ends_a[cut_a - 1].tolist() == ends_b[cut_b - 1].tolist() == sorted(set(ends_a.tolist()) & set(ends_b.tolist()))
        from_a, from_b = np.concatenate([[0], ends_a[:-1]]), np.concatenate([[0], ends_b[:-1]])
        want = [(i, j) for i in range(len(ends_a)) for j in range(len(ends_b)) if from_a[i] < ends_b[j] and from_b[j] < ends_a[i]]
        assert sorted(zip(*(x.tolist() for x in align.links(cut_a, cut_b, ends_a, ends_b)))) == want
