"""Collocations against plain Python."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rawlake.llm import phrases


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, words, least, top, share):
    found, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", fold(text)):
            own = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(own)
            for n in range(1, words + 1):
                for i in range(len(own) - n + 1):
                    found[lang][tuple(own[i : i + n])] += 1
    out = []
    for lang, f in found.items():
        kept = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = set()
        for p, a in kept.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    part = p[i : i + m]
                    if 100 * a >= share * f[part]:
                        inside.add(part)
        scored = []
        for p, a in kept.items():
            if p not in inside:
                score, _, l, r = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "The", "new", "york", "é", "Ä", "日本", "x\x1cy", "city", " ", "a-b", "%"]
    made = []
    for _ in range(400):
        own = [rng.choice(vocabulary) if rng.random() < 0.6 else rng.choice(["new york city", "of the new\tyork", "a b c d e"]) for _ in range(rng.randint(0, 30))]
        made.append(("".join(w + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", "!", "\x0b"]) for w in own), rng.choice(["en", "en", "en", "de", None, "und"])))
    return made + [(None, "en"), ("", "fr"), (" \t\n", None), ("word " * 5000, "de"), ("one two", "xx")] + [made[0]] * 40


@pytest.mark.parametrize("words,least,top,share", [(4, 30, 2000, 80), (3, 5, 7, 50), (2, 1, 5, 80), (5, 300, 40, 100)])
def test_collocations_agree_with_plain_python(spark, words, least, top, share):
    rows = corpus(words)
    docs = spark.createDataFrame([(t, g, 1, "z") for t, g in rows], "text string, lang string, n int, phrase string").repartition(4)
    got = sorted(map(tuple, phrases.mine(docs, words=words, least=least, top=top, share=share).collect()))
    assert got == brute(rows, words, least, top, share)
    assert got


def test_bundles_and_blocks_of_any_size_agree(spark, monkeypatch):
    rows = corpus(9)
    docs = spark.createDataFrame(rows, "text string, lang string")
    whole = sorted(map(tuple, phrases.mine(docs).collect()))

    class Small(phrases._Shape):
        def __init__(self, *args):
            super().__init__(*args)
            self.bits, self.block_bits, self.pack_bytes = 10, 6, 3000

    monkeypatch.setattr(phrases, "_Shape", Small)
    assert sorted(map(tuple, phrases.mine(docs).collect())) == whole == brute(rows, 4, 30, 2000, 80)


def test_products_beyond_64_bits_are_exact(spark):
    big = 4_000_000_000_000_000_001
    rows = [("l", "a b", 2, big, [big + 5], [big + 3], None), ("l", "a c", 2, big, [big], [big], big), ("l", "a d", 2, big, [big], [big], big * 8 // 10 - 1)]
    df = spark.createDataFrame(rows, "lang string, phrase string, n int, a bigint, firsts array<bigint>, rests array<bigint>, beyond bigint")
    got = {r["phrase"]: r["score"] for r in phrases.scored(df).collect()}
    assert got == {"a b": 2_000_000 * big // (2 * big + 8), "a d": 1_000_000}


def test_ties_go_to_the_first_cut(spark):
    rows = [("l", "a b c", 3, 30, [60, 50], [50, 60], None)]
    df = spark.createDataFrame(rows, "lang string, phrase string, n int, a bigint, firsts array<bigint>, rests array<bigint>, beyond bigint")
    (row,) = phrases.scored(df).collect()
    assert (row["l"], row["r"]) == (60, 50)


def test_an_empty_table_has_no_phrases(spark):
    assert phrases.mine(spark.createDataFrame([], "text string, lang string")).collect() == []


def test_one_pair_that_makes_up_a_third_of_all_words_is_counted_in_parts(spark):
    docs = spark.range(3000).select(F.lit("hot pair. " * 10 + "cold").alias("text"), F.lit("en").alias("lang"))
    (row,) = phrases.mine(docs).collect()
    assert tuple(row) == ("en", 1, "hot pair", 30000, 30000, 30000, 63000, 1_000_000)
