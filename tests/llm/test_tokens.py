"""Byte-pair encoding and fill-in-middle forms against the library and plain Python."""

import base64
import hashlib
import random
import re

import pytest
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from rawlake.llm import bpe, middle, queries

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def coder():
    with open(RANKS, "rb") as file:
        return bpe.vocabulary(file.read(), public_tokenizers.PATTERN)


def texts():
    rng = random.Random(7)
    kinds = ["ab", "thein ", "é ñüß", " \n\t\x0b\r\x85\xa0", "0123456789", "!?.-'s", "日本語😀", "aA  <PSM>|", "\x00\x1c\x1f\x7f"]
    made = ["".join(rng.choice(rng.choice(kinds)) for _ in range(rng.randint(1, 80))) for _ in range(1500)]
    return made + ["a" * 5000, " " * 5000, "ab" * 3000, " the" * 4000, "\n" * 300 + "x", "<|endoftext|>", "it's <P> here", "x<S>", "<M>"]


def table(spark):
    rows = [(k, t, "other", "n") for k, t in enumerate(texts())] + [(None, "no id", "o", "n"), (10**9, None, "o", "n"), (5, "", None, None)]
    rows += [rows[3]] * 2
    return spark.createDataFrame(rows, "`doc id` bigint, text string, ids string, n string").repartition(5), rows


def test_encode_and_decode_agree_with_the_library(spark):
    docs, rows = table(spark)
    other = library()
    got = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN, "doc id"), RANKS).collect()
    want = [(k, other.encode_ordinary(t or ""), (t or "").encode()) for k, t, *_ in rows]
    assert sorted(map(repr, want)) == sorted(repr((r["doc id"], list(r["ids"]), bytes(r["decoded"]))) for r in got)
    packed = bpe.encode(docs, RANKS, public_tokenizers.PATTERN, "doc id", packed=True).collect()
    assert sorted(repr((k, b"".join(i.to_bytes(4, "little") for i in ids))) for k, ids, _ in want) == sorted(repr((r[0], bytes(r[1]))) for r in packed)


def test_one_match_of_any_length_takes_linear_time(coder):
    for size in (1 << 12, 1 << 15):
        rng = random.Random(size)
        piece = "".join(rng.choice("etaoin") for _ in range(size)).encode()
        seen = []
        coder.words, own = CountingWords(coder.words, seen), coder.words
        try:
            ids = coder.encode_piece(piece)
        finally:
            coder.words = own
        assert b"".join(coder.tokens[i] for i in ids) == piece
        assert sum(seen) < 150 * size  # bytes handed to the automaton, at most the longest token for each visit


class CountingWords:
    def __init__(self, words, seen):
        self.words, self.seen = words, seen

    def iter_long(self, text):
        self.seen.append(len(text))
        return self.words.iter_long(text)


def vocabulary_of(tokens):
    return bpe.Vocabulary(b"\n".join(base64.b64encode(t) + b" %d" % k for k, t in enumerate(tokens)), r"\w+")


def test_walk_gives_the_merges_for_ordered_vocabularies():
    checked = 0
    for seed in range(150):
        rng = random.Random(seed)
        tokens = [bytes([b]) for b in range(256)]
        inner = [b"a", b"b", b"c"]
        while len(tokens) < 290:
            new = rng.choice(inner) + rng.choice(inner)
            if len(new) < 7 and new not in tokens:
                grown = vocabulary_of([*tokens, new])
                if grown.ordered():
                    tokens.append(new)
                    inner.append(new)
            if rng.random() < 0.02:
                break
        own = vocabulary_of(tokens)
        assert own.ordered()
        for _ in range(60):
            piece = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 24)))
            assert own.encode_piece(piece) == ([own.ranks[piece]] if piece in own.ranks else own.merge(piece)), (seed, piece)
            checked += 1
    assert checked == 9000


def test_other_vocabularies_are_merged_one_by_one(spark, tmp_path):
    tokens = [bytes([b]) for b in range(256)] + [b"abc", b"bc", b"ab"]
    assert not vocabulary_of(tokens).ordered()
    path = tmp_path / "odd"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" %d" % k for k, t in enumerate(tokens)))
    other = tiktoken.Encoding("odd", pat_str=r"\w+", mergeable_ranks={t: k for k, t in enumerate(tokens)}, special_tokens={})
    rows = [(k, t) for k, t in enumerate(["abcab", "xabc", "bcabc", "aabcc bcbc"])]
    got = bpe.encode(spark.createDataFrame(rows, "doc_id bigint, text string"), str(path), r"\w+").collect()
    assert {r["doc_id"]: list(r["ids"]) for r in got} == {k: other.encode_ordinary(t) for k, t in rows}


def test_decoding_refuses_unknown_ids_and_keeps_nulls(spark, coder):
    df = spark.createDataFrame([(1, [0, 1]), (2, None), (3, [])], "k int, ids array<int>")
    assert {r["k"]: r["decoded"] and bytes(r["decoded"]) for r in bpe.decode(df, RANKS).collect()} == {1: coder.tokens[0] + coder.tokens[1], 2: None, 3: b""}
    for wrong in (50256, -1, 10**6):
        with pytest.raises(Exception, match="not in the vocabulary"):
            bpe.decode(spark.createDataFrame([([wrong],)], "ids array<int>"), RANKS).collect()


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert bpe.decode(bpe.encode(none, RANKS, public_tokenizers.PATTERN), RANKS).collect() == []
    assert middle.transform(none).collect() == []


def brute_form(k, text):
    text = text or ""
    units = UNITS.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"42:{'' if k is None else k}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_forms_agree_with_plain_python_and_texts_come_back(spark):
    docs, rows = table(spark)
    formed = middle.transform(docs, "doc id")
    want = sorted(repr((k, *brute_form(k, t))) for k, t, *_ in rows)
    assert want == sorted(repr(tuple(r)) for r in formed.collect())
    assert len({w.split("'")[1] for w in want}) == 3
    back = middle.restored(formed.withColumn("text", F.lit("another")).withColumn("_row", F.lit(1)))
    assert back.columns.count("text") == 1
    assert sorted(repr((r["doc id"], r["text"])) for r in back.collect()) == sorted(repr((k, t or "")) for k, t, *_ in rows)


def test_units_end_where_the_pattern_says():
    rng = random.Random(2)
    for _ in range(5000):
        text = "".join(rng.choice(" \t\n\x0b\x0c\r\x08\x0e\x00\x1f\x7fabé日😀\x85\xa0 ") for _ in range(rng.randint(0, 40)))
        raw, units = text.encode(), UNITS.findall(text)
        ends = middle.UnitEnds(raw)
        assert ends.n == len(units)
        assert [raw[: ends.place(k)].decode() for k in range(len(units) + 1)] == ["".join(units[:k]) for k in range(len(units) + 1)]
        assert middle.code_points(raw) == len(text)


def test_queries_against_the_library_and_plain_python(spark, sf):
    docs = [(r["doc_id"], r["text"] or "") for r in queries.table(spark, sf, "documents").collect()]
    other, sha = library(), lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for k, t in docs:
        ids = other.encode_ordinary(t)
        want.append((k, len(ids), sha(b"".join(i.to_bytes(4, "little") for i in ids)), sha(t.encode())))
    assert sorted(map(tuple, queries.op11_byte_bpe(spark, sf).collect())) == sorted(want)
    want = []
    for k, t in docs:
        n, form, first, mid, output = brute_form(k, t)
        want.append((k, n, form, first, mid, sha(output.encode()), sha(t.encode())))
    assert sorted(map(tuple, queries.op12_fill_in_middle(spark, sf).collect())) == sorted(want)
