"""Corpus operators against brute force, on small made-up tables with every odd case."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from rawlake.llm import chat, classifier, contamination, licenses, lines, mixing, near, personal, quality_rules, substrings
from rawlake.llm.common import hash_words, join_counted, letter_words, rolling
from rawlake.llm.components import components

SPACES = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return SPACES.findall(text or "")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def letters(text):
    return LETTERS.findall(lower(text))


def corpus():
    """Nulls, empty, blank and very long texts, ties, repeated rows, shared passages."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeéßÀQ") for _ in range(rng.randint(1, 6))) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    passage, lined = prose(60), "\n".join(prose(5) for _ in range(6))
    rows = [(1, None, "a"), (2, "", "a"), (3, " \t\n ", None), (4, prose(20), "b"), (None, prose(80), "b"), (None, None, None)]
    rows += [(k, prose(rng.randint(1, 120)), rng.choice(["a", "b", "c", None, "é"])) for k in range(10, 40)]
    rows += [(k, f"{prose(15)} {passage}\n{prose(9)}", "a") for k in range(40, 50)]
    rows += [(k, f"{prose(4)}\n{lined}\n{prose(4)}", "a") for k in range(50, 60)]
    rows += [(60, passage, "a")] * 3 + [(61, prose(9) + " x" * 3000 + "\n" * 40, "c"), (62, "one\x0btwo\x0cthree four", "c")]
    base = prose(200).split()
    for k in range(70, 90):
        copy = list(base)
        copy[rng.randrange(200)] = "changed"
        rows.append((k, " ".join(copy), "b"))
    return rows, vocabulary


@pytest.fixture(scope="module")
def rows():
    return corpus()[0]


@pytest.fixture(scope="module")
def docs(spark, rows):
    # Extra columns whose names the operators use themselves.
    more = [(*r, "x", 7, None, [1]) for r in rows]
    schema = "doc_id bigint, text string, source string, words string, n bigint, _thash bigint, starts array<int>"
    return spark.createDataFrame(more, schema).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, source string, n_chars bigint")


def got(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_substrings(docs, rows):
    seen = Counter()
    for _, text, _ in rows:
        w = words(text)
        seen.update(tuple(w[i : i + 35]) for i in range(len(w) - 34))
    want = []
    for doc_id, text, _ in rows:
        w = words(text)
        gone = {i + k for i in range(len(w) - 34) if seen[tuple(w[i : i + 35])] > 1 for k in range(35)}
        want.append((doc_id, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    assert got(substrings.deduplicate(docs)) == sorted(want, key=repr)
    assert any(n for _, _, n, _ in want)


def test_substrings_in_many_packs(docs, monkeypatch):
    want = got(substrings.deduplicate(docs))
    monkeypatch.setattr(substrings, "PACK_BYTES", 700)
    assert got(substrings.deduplicate(docs.repartition(1))) == want


def test_substrings_with_a_sketch_that_tells_nothing(docs, monkeypatch):
    """If all windows look repeated, the exact pass still decides."""
    want = got(substrings.deduplicate(docs))
    monkeypatch.setattr(substrings._Shape, "estimated", lambda self, hashes, answers: np.ones(len(hashes), bool))
    rowwise = substrings._Shape(35, 22)
    assert rowwise.estimated(np.arange(3, dtype=np.uint64), {}).all()
    assert want


@pytest.mark.parametrize("bits", [3, 8, 22])
def test_compact_lists(bits):
    rng = np.random.default_rng(bits)
    for n in (0, 1, 2, 7, min(1 << bits, 500)):
        values = np.sort(rng.choice(1 << bits, n, replace=False)).astype(np.uint64)
        assert (substrings.decode(substrings.encode(values, bits), bits) == values).all()


def test_rolling_hashes_are_of_the_words_alone():
    a = rolling(hash_words([b"x", b"y", b"z", b"w"]), 3)
    b = rolling(hash_words([b"q", b"x", b"y", b"z"]), 3)
    assert a[0] == b[1] and a[1] != b[0] and len(rolling(hash_words([b"x"]), 3)) == 0


def brute_lines(rows):
    keys = sorted({(r[0] is not None, r[0] or 0, xxhash.xxh64_intdigest((r[1] or "").encode(), 42), r[1]) for r in rows if r[1] is not None}, key=lambda k: (k[0], k[1], (k[2] + 2**63) % 2**64))
    first = {}
    for key in keys:
        own = key[3].split("\n")
        for i in range(len(own) - 2):
            if SPACES.search("".join(own[i : i + 3])):
                first.setdefault(tuple(own[i : i + 3]), (key, i))
    out = []
    for doc_id, text, _ in rows:
        if text is None:
            out.append((doc_id, 0, 0, None))
            continue
        own = text.split("\n")
        me = (doc_id is not None, doc_id or 0, xxhash.xxh64_intdigest(text.encode(), 42), text)
        gone = {i + k for i in range(len(own) - 2) if first.get(tuple(own[i : i + 3]), (me, i)) != (me, i) for k in range(3)}
        out.append((doc_id, len(own), len(gone), "\n".join(x for i, x in enumerate(own) if i not in gone)))
    return out


def test_lines(docs, rows):
    want = brute_lines(rows)
    assert got(lines.deduplicate(docs)) == sorted(want, key=repr)
    assert sum(w[2] for w in want) > 50


def test_line_rewrite_keeps_columns_and_counts_anew(spark):
    same = "a b\nc d\ne f\ng h"
    df = spark.createDataFrame([(1, same, 15, "s"), (2, same, 15, "s"), (3, f"x\n{same}", 17, None), (4, "", 0, None), (5, None, None, "s")], "doc_id bigint, text string, n_chars bigint, _starts string")
    out = lines.rewrite(df)
    assert out.columns == df.columns
    assert got(out) == sorted([(1, same, 15, "s"), (3, "x", 1, None), (4, "", 0, None), (5, None, None, "s")], key=repr)


def test_lines_plan_is_native(docs):
    plan = lines.deduplicate(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def brute_targets(rows):
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(words(text))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, free, target = 1.5 * sum(sizes.values()), set(order), {}
    while free:
        over = {s for s in free if left * weight[s] / sum(weight[x] for x in free) >= 2 * sizes[s]}
        if not over:
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
        free, left = free - over, left - sum(target[s] for s in over)
    total = sum(weight[x] for x in free)
    target.update({s: left * weight[s] / total for s in free})
    return sizes, target


def test_mix(docs, rows):
    sizes, target = brute_targets(rows)
    out = mixing.mix(docs, keep_key=True).collect()
    assert sorted(((r.doc_id, r.size) for r in out), key=repr) == sorted(((i, len(words(t))) for i, t, _ in rows), key=repr)
    taken, largest = Counter(), defaultdict(int)
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= largest[s]
    assert got(mixing.mix(docs.repartition(5))) == got(mixing.mix(docs))


def test_mix_in_many_blocks(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(k, "w " * rng.randint(1, 60), "abc"[k % 3]) for k in range(3000)], "doc_id bigint, text string, source string")
    out = mixing.mix(df, block=64).groupBy("target").agg(F.sum("taken").alias("taken"), F.sum("copies").alias("copies"), F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    for r in out:
        assert abs(r.taken - r.target) <= 60
        # Documents are balanced as well as words.
        assert abs(r.copies - r.n * r.target / r.size) <= 3


def test_mix_of_one_source_and_of_no_words(spark):
    df = spark.createDataFrame([(1, "", "a"), (2, None, "a")], "doc_id bigint, text string, source string")
    assert [(r.target, r.taken) for r in mixing.mix(df).collect()] == [(0.0, 0), (0.0, 0)]
    df = spark.createDataFrame([(k, "a b", "s") for k in range(10)], "doc_id bigint, text string, source string")
    assert sum(r.taken for r in mixing.mix(df).collect()) == 30


def test_balance_keeps_both_sums():
    rng = np.random.default_rng(1)
    sizes, parts = rng.integers(1, 500, 400).astype(float), rng.random(400)
    words_before, count_before = (sizes * parts).sum(), parts.sum()
    left = mixing.balance(sizes, parts, rng)
    assert len(left) <= 2 and (sizes * parts).sum() == pytest.approx(words_before, rel=1e-6) and parts.sum() == pytest.approx(count_before, rel=1e-6)


def brute_simhash(text):
    w = lower(text).replace(" ", " ")
    w = SPACES.findall(w)
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def brute_groups(rows):
    prints = [brute_simhash(t) for _, t, _ in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 3]
    root = brute_components(range(len(rows)), links)
    least = {}
    for k, (doc_id, _, _) in enumerate(rows):
        if doc_id is not None:
            least[root[k]] = min(doc_id, least.get(root[k], doc_id))
    return [(r[0], prints[k], least.get(root[k])) for k, r in enumerate(rows)]


def test_simhash_groups(docs, rows):
    out = [(r.doc_id, r.fingerprint % 2**64, r.component_id) for r in near.group(docs).collect()]
    want = brute_groups(rows)
    assert sorted(out, key=repr) == sorted(want, key=repr)
    assert len({w[2] for w in want}) < len({w[0] for w in want}) - 5


@pytest.mark.parametrize("bucket", [1024, 24])
def test_links_lose_no_pair(spark, monkeypatch, bucket):
    """Dense groups too, whose buckets are dealt out again under finer masks."""
    monkeypatch.setattr(near, "BUCKET", bucket)
    rng = random.Random(bucket)
    prints = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(40):
            p = base
            for b in rng.sample(range(64), rng.randint(0, 5)):
                p ^= 1 << b
            prints.add(p)
    prints = sorted(prints)
    signed = [p - 2**64 if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    found = {r.node: r.root for r in components(near._links(df)).collect()}
    links = [(a, b) for i, a in enumerate(prints) for b in prints[:i] if (a ^ b).bit_count() <= 3]
    want = brute_components(prints, links)
    groups = defaultdict(set)
    for s, p in zip(signed, prints):
        groups[want[p]].add(s)
    ours = defaultdict(set)
    for s in signed:
        ours[found.get(s, s)].add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, ours.values()))


def test_bucket_sizes_count_each_fingerprint_once(spark, monkeypatch):
    """Finer masks that several masks share hold a fingerprint once."""
    monkeypatch.setattr(near, "BUCKET", 24)
    write, sizes, rounds = near.materialize, [], []

    def spied(df, name):
        out = write(df, name)
        if name == "bucket-sizes":
            sizes.append(out.agg(F.max("n")).first()[0])
        if name == "large-buckets":
            rounds.append(out.count() - out.distinct().count())
        return out

    monkeypatch.setattr(near, "materialize", spied)
    prints = [(k,) for k in range(40)]
    near._links(spark.createDataFrame(prints, "fp bigint"))
    assert max(s or 0 for s in sizes) <= len(prints) and len(rounds) > 1 and not any(rounds)


def test_masks_cover_every_pair_of_three_bits():
    rng = random.Random(2)
    masks = near._masks()
    assert len(masks) == 10
    for _ in range(500):
        diff = sum(1 << b for b in rng.sample(range(64), 3))
        hit = [m for m in masks if not m & diff]
        assert hit and all(any(not f & diff for f in near.finer(m)) for m in hit)


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 300)] + [(500, 500), (400, 401), (401, 400)]
    out = {r.node: r.root for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 300), 100), 400: 400, 401: 400}
    assert out == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_join_with_hot_keys_loses_nothing(spark):
    left = spark.createDataFrame([(k % 7 if k % 3 else 0, k) for k in range(5000)], "k bigint, v bigint")
    right = left.filter("k != 5").groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("m"))
    assert got(join_counted(left, right, ["k"], "n")) == got(left.join(right, "k").select("k", "v", "n", "m"))


def brute_hits(rows, items):
    windows = defaultdict(set)
    for item, text in items:
        w = letters(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1) if n else ():
            windows[tuple(w[i : i + n])].add(item)
    out = []
    for doc_id, text, _ in rows:
        w, hit, found = letters(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        out.append((doc_id, len(w), len(hit), sorted(str(x) for x in found if x is not None), bool(hit)))
    return out


def test_contamination(spark, docs, rows):
    items = [(7, " ".join(words(rows[-1][1])[20:50]).upper()), (8, rows[36][1]), (9, "three four"), (10, None), (11, ""), (12, "!!"), (9, "three four"), (None, "two THREE"), (2, rows[45][1][:90])]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    out = contamination.find(docs, bench).select("doc_id", "n_words", "n_hit", "items", "contaminated")
    want = brute_hits(rows, items)
    assert got(out) == sorted(want, key=repr)
    assert sum(w[4] for w in want) > 10


def test_contamination_without_broadcast_or_benchmark(spark, docs, rows, monkeypatch):
    items = [(3, rows[-1][1]), (4, "changed")]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = got(contamination.find(docs, bench))
    monkeypatch.setattr(contamination, "small", lambda df, n: False)
    assert got(contamination.find(docs, bench)) == want
    assert contamination.find(docs, bench.limit(0)).filter("contaminated OR n_hit > 0 OR size(items) > 0").count() == 0


def test_contamination_plan_is_native(spark, docs):
    bench = spark.createDataFrame([(3, "a b c")], "item_id bigint, text string")
    plan = contamination.find(docs, bench)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def brute_statistics(text):
    w = words(text)
    own = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    seen = Counter(own)
    covered = {i + k for i, x in enumerate(own) if seen[x] > 1 for k in range(3)}
    full = [x for x in (text or "").split("\n") if SPACES.search(x)]
    dup = sum(x in full[:i] for i, x in enumerate(full))
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_quality_statistics(spark, docs, rows):
    trusted = spark.createDataFrame([(k,) for k in (40, 41, 42, 70, None, 9999)], "doc_id bigint")
    out = quality_rules.judge(docs, trusted, cells=1 << 10)
    want = [(r[0], *brute_statistics(r[1])) for r in rows]
    assert got(out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == sorted(want, key=repr)
    assert out.filter("base_failed <> (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) OR (base_failed AND kept)").count() == 0


def test_log_ratio_scores(spark, docs, rows):
    """Scores are the mean log ratio of the two smoothed cell distributions."""
    cells, chosen = 1 << 10, {40, 41, 42, 70}
    own_cells = {}
    raw, own = np.zeros(cells), np.zeros(cells)
    for k, (doc_id, text, _) in enumerate(rows):
        hashes = hash_words([lower(w).encode() for w in words(text)])
        own_cells[k] = quality_rules._cells(hashes, cells) if len(hashes) else np.zeros(0, int)
        np.add.at(raw, own_cells[k], 1)
        if doc_id in chosen:
            np.add.at(own, own_cells[k], 1)
    ratio = np.log((own + 0.5) / (own + 0.5).sum()) - np.log((raw + 0.5) / (raw + 0.5).sum())
    trusted = spark.createDataFrame([(k,) for k in chosen], "doc_id bigint")
    out = quality_rules.judge(docs, trusted, cells=cells).collect()
    want = sorted(round(float(ratio[c].mean()), 9) if len(c) else 0.0 for c in own_cells.values())
    assert sorted(round(r.score, 9) for r in out) == pytest.approx(want)
    assert {r.doc_id for r in out if r.kept} >= chosen


def test_quality_without_trusted_documents(spark, docs):
    out = quality_rules.judge(docs, spark.createDataFrame([], "doc_id bigint"))
    assert out.filter("kept = base_failed").count() == 0


def test_threshold_keeps_held_out_documents(spark):
    """Clean documents outside the trusted part pass like those in it, foreign ones do not."""
    rng = random.Random(9)

    def prose(letters, kinds=3000):
        return " ".join(rng.choice(letters) + str(rng.randrange(kinds)) for _ in range(80))

    rows = [(k, prose("abcd")) for k in range(400)] + [(k, prose("wxyz")) for k in range(400, 600)]
    trusted = spark.createDataFrame([(k,) for k in range(200)], "doc_id bigint")
    out = {r.doc_id: r.kept for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id bigint, text string"), trusted).collect()}
    assert sum(out[k] for k in range(200)) >= 199
    assert sum(out[k] for k in range(200, 400)) >= 190 and not any(out[k] for k in range(400, 600))


def brute_places(text):
    w = letters(text)
    found = [(i, label) for phrase, label in licenses.PHRASES for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    return len(w), len(found), min((i for i, _ in found), default=None), max((i for i, _ in found), default=None), ",".join(sorted({x for _, x in found}))


def test_licenses(spark):
    texts = [
        None, "", "Apache License", "under the MIT LICENSE, mit license; CC-BY cc by by", "the gnu general public licenses",
        "x " * 50 + "Permission is hereby granted free of charge to any person obtaining the copy of this software and associated documentation files",
        "released under the mit\nlicense é", "no license here, mit permission is granted of charge", "Licensed under CC BY-NC 4.0. " * 3,
        "cc by cc by cc", "w " * 40000 + "apache license",
    ]
    df = spark.createDataFrame([(k % 9, t) for k, t in enumerate(texts)] + [(None, "mit license")], "doc_id bigint, text string")
    out = licenses.scan(df)
    want = [(k % 9, *brute_places(t)) for k, t in enumerate(texts)] + [(None, *brute_places("mit license"))]
    assert got(out.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ","))) == sorted(want, key=repr)
    labels = {(r.doc_id, tuple(r.labels), r.score) for r in out.collect()}
    assert (5, ("mit",), max(x[2] for x in labels if x[0] == 5)) in labels and (7, (), 0.0) in labels
    assert any(x[0] == 8 and x[1] == ("cc-by", "cc-by-nc") for x in labels)
    assert all(0 <= x[2] <= 1 for x in labels)


def test_license_spans_bridge_changed_words(spark):
    df = spark.createDataFrame([(1, "so THIS work is newly licensed under a creative commons attribution 4.0 international license ok")], "doc_id bigint, text string")
    (row,) = licenses.scan(df).collect()
    assert [(s.label, s.start) for s in row.spans] == [("cc-by", 6)] or row.spans[0].label == "cc-by"


def conversations(spark):
    rng = random.Random(8)
    rows = []
    for conv in range(12):
        if conv % 3 == 0:
            rows.append((conv, 0, "system", "be good <|im_end|>\n"))
        for turn in range(1, rng.randint(2, 30)):
            text = rng.choice(["hi ", "<|im_start|>", "<\\|", "[INST]", "a\\b\n", "</s>", "<<SYS>>", "é "]) * rng.randint(0, 200)
            rows.append((conv, turn, rng.choice(["user", "assistant", "to\nol\\n", None]), text or None))
    rows += [(None, 1, "assistant", "lost"), (50, 1, "assistant", "tie b"), (50, 1, "assistant", "tie a"), (50, 1, "assistant", "tie a"), (51, None, None, None)]
    rows += [(52, k, "user" if k % 2 else "assistant", "long " * 3000) for k in range(3)]
    return rows, spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def brute_chat(rows):
    out = []
    for conv in {r[0] for r in rows}:
        own = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: [(x is not None, x or 0 if isinstance(x, int) else x or "") for x in r])
        whole = "".join(f"{r or ''}\n{t or ''}\n" for _, r, t in own)
        loss = "".join(t or "" for _, r, t in own if r == "assistant")
        out.append((conv, len(own), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("budget", [60, 400, 10**9])
def test_chat_round_trip(spark, budget):
    rows, df = conversations(spark)
    windows = chat.format_windows(df, budget=budget, history=budget // 4)
    out = chat.read_back(windows).drop("formatted_chars")
    assert got(out) == sorted(brute_chat(rows), key=repr)
    for w in windows.collect():
        turns = chat.parse(w.text)
        assert w.n_repeated < len(turns)
        assert sum(chat.tokens(t) for _, t in turns) <= budget or len(turns) - w.n_repeated == 1
        for t in w.targets:
            assert chat.unescape(w.text[t.start : t.end]) in [b for r, b in turns[w.n_repeated :] if r == "assistant"]
        if w.conv_id is not None and w.conv_id % 3 == 0 and w.conv_id < 12:
            assert turns[0][0] == "system"


def test_escapes_hide_control_strings():
    for text in ("<|x|>", "<\\|", "</s><s>", "[INST][/INST]", "<<SYS>><</SYS>>", "[\\/INST]", "<<|", "plain < | ["):
        assert chat.unescape(chat.escape(text)) == text
        assert not re.search(r"<\||</?s>|\[/?INST\]|<</?SYS>>", chat.escape(text))
    role = "a\\n\nb<|"
    assert chat._role_in(chat._role_out(role)) == role and "\n" not in chat._role_out(role)


def brute_base(text):
    out = []
    for kind, pattern in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and personal.luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def test_base_patterns():
    rng = random.Random(4)
    pieces = ["a", "b.c", "@", ".", "_", "-", " ", "+", "1", "23", "4", "255", "256", "0", "(", ")", "4111 1111 1111 1111", "1.2.3.4", "x@y.zz", "+1 (017) 555-7713", "é", "\n"]
    for _ in range(4000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))
        assert [s[:3] for s in personal.spans(text) if s[0] in personal.BASE] == brute_base(text), text


def test_checksums_context_and_long_runs():
    assert personal.mod97("DE89370400440532013000") and not personal.mod97("DE89370400440532013001") and personal.luhn("4111111111111111")
    kinds = [s[0] for s in personal.spans("my bank: DE89 3704 0044 0532 0130 00, ssn 078-05-1120")]
    assert kinds == ["iban", "ssn"] and [s[0] for s in personal.spans("order 078-05-1120")] == []
    assert [s[0] for s in personal.spans('token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"')] == ["secret"]
    long = "a" * 300_000 + " " + "1" * 300_000 + " " + "a@" * 50_000 + "1." * 50_000
    assert personal.spans(long) is not None


def test_secrets_in_either_case_and_numbers_before_words():
    secret = "04DBEBAB91AB85687D33EEAAF9AC699E1188F962"
    assert [s[:3] for s in personal.spans(f"TOKEN = {secret}")] == [("secret", 8, 48)]
    assert personal.spans("token " + "ABCDEF" * 6) == []
    polish, german = "PL61 1090 1014 0000 0712 1981 2874", "DE89 3704 0044 0532 0130 00"
    for text in (f"{polish} USD", f"{polish} PAID NOW", f"{polish} {german}", f"NO12 1234 {german} X", polish.replace(" ", "") + " USD"):
        want = [n for n in (polish, polish.replace(" ", ""), german) if n in text]
        assert [text[a:b] for kind, a, b, _ in personal.spans(text) if kind == "iban"] == want, text
    assert personal.spans("AB12 " * 50_000) == []


def test_personal_table(spark):
    df = spark.createDataFrame([(1, None, 3), (2, "", 3), (None, "x@y.zz", 3), (4, "é 1.2.3.4", 3)], "doc_id bigint, text string, spans bigint")
    out = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in personal.find(df).collect()}
    assert out == {1: [], 2: [], None: [("email", 0, 6)], 4: [("ip", 2, 9)]}


def test_classifier_learns_and_orders_grades(spark):
    rng = random.Random(6)
    vocabulary = [f"w{k}" for k in range(400)]
    rows, truth = [], {}
    for k in range(900):
        text = " ".join(rng.choice(vocabulary) for _ in range(60))
        grade = rng.choice([0, 1, 2, 2])
        text = f"{text} scum" if grade == 0 else " ".join(f"{w}***" for w in text.split()) if grade == 1 else text
        rows.append((k, text, 5))
        truth[k] = grade
    rows += [(None, "scum", 5), (2000, None, 5), (2001, "", 5), (2002, " \n", 5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, tail bigint")
    ratings = spark.createDataFrame([(k, truth[k]) for k in range(600)] + [(None, 1), (3, None), (9999, 2), (2000, 2)], "doc_id bigint, grade int")
    model = classifier.fit(df, ratings)
    assert (np.diff(model.cuts) > 0).all()
    out = {r.doc_id: r._grade for r in classifier.grade(df, model).collect()}
    held = [k for k in truth if k >= 600]
    right = sum((out[k].tail >= 0.5) == (truth[k] == 2) for k in held)
    assert right >= 0.97 * len(held)
    mean = [np.mean([out[k].expected for k in held if truth[k] == g]) for g in range(3)]
    assert mean[0] < mean[1] < mean[2]
    assert out[2000].tail == out[2001].tail == out[2002].tail == 0
    assert classifier.fit(df, ratings, sample=100).weights.any()
    assert not classifier.fit(df, ratings.limit(0)).weights.any()


def test_classifier_reads_documents_in_many_tasks(spark, tmp_path, monkeypatch):
    extract, seen = classifier._extract, str(tmp_path)

    def spied(batches):
        from pyspark import TaskContext

        for batch in batches:
            if batch.num_rows:
                open(f"{seen}/{TaskContext.get().partitionId()}", "w").close()
            yield from extract(iter([batch]))

    monkeypatch.setattr(classifier, "_extract", spied)
    docs = spark.createDataFrame([(k, f"word{k % 7} and more") for k in range(80)], "doc_id bigint, text string").repartition(4)
    classifier.fit(spark.createDataFrame(docs.rdd, docs.schema), spark.createDataFrame([(k, k % 3) for k in range(80)], "doc_id bigint, grade int"))
    assert len(list(tmp_path.iterdir())) > 1


def test_gradient_of_the_ordinal_loss():
    rng = np.random.default_rng(0)
    margins, y, cuts = rng.normal(size=6), np.array([0, 1, 2, 1, 0, 2]), np.array([-0.4, 0.7])

    def loss(m, c):
        t = 1 / (1 + np.exp(-(m[:, None] - c)))
        u = np.concatenate([np.ones((6, 1)), t, np.zeros((6, 1))], 1)
        return -np.log(u[np.arange(6), y] - u[np.arange(6), y + 1])

    slope, by_cut = classifier._gradient(margins, y, cuts)
    e = 1e-6
    assert slope == pytest.approx((loss(margins + e, cuts) - loss(margins - e, cuts)) / (2 * e), rel=1e-4)
    for k in range(2):
        d = np.eye(2)[k] * e
        assert by_cut[k] == pytest.approx((loss(margins, cuts + d) - loss(margins, cuts - d)).mean() / (2 * e), rel=1e-4)


def test_empty_tables(spark, none):
    ids, bench = none.select("doc_id"), spark.createDataFrame([], "item_id bigint, text string")
    turns = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    model = classifier.fit(none, spark.createDataFrame([], "doc_id bigint, grade int"))
    for out in (
        substrings.deduplicate(none), lines.deduplicate(none), lines.rewrite(none), mixing.mix(none), near.group(none), contamination.find(none, bench),
        quality_rules.judge(none, ids), licenses.scan(none), chat.read_back(chat.format_windows(turns)), personal.find(none), classifier.grade(none, model),
    ):
        assert out.count() == 0


def test_word_classes():
    text = "A-b_c É9\x7fz ß\x00q"
    assert [w.decode() for w in letter_words(text.encode())] == letters(text)
