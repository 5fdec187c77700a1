"""The corpus pipeline, stage by stage, against plain Python over the same input."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from oracle import compare, duck
from rawlake.llm import classifier, queries
from rawlake.session import materialize
from test_corpus import brute_base, brute_chat, brute_components, brute_hits, brute_lines, brute_places, brute_simhash, brute_targets, words


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs = queries.table(spark, sf, "documents")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf), f"test-{name}")
        out.append((name, docs))
    return dict(out)


def plain(df):
    return [(r.doc_id, r.text, r.source) for r in df.collect()]


def test_columns_and_order(stages):
    names = list(stages)
    assert names[1:] == ["quality_classifier", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "source_mix"]
    for name in names[:-1]:
        assert stages[name].columns == stages["documents"].columns


def test_classifier_stage_keeps_good_and_drops_toxic(spark, sf, stages):
    graded = queries.rated(queries.table(spark, sf, "labels"))
    kept = {r.doc_id for r in stages["quality_classifier"].collect()}
    by = defaultdict(list)
    for r in graded.collect():
        by[r.grade].append(r.doc_id in kept)
    assert sum(by[2]) >= 0.98 * len(by[2]) and 2 * sum(by[0]) < len(by[0])
    model = classifier.fit(stages["documents"], graded)
    for doc_id, text, _ in plain(stages["documents"])[:100]:
        margin = model.weights[classifier.features(text.encode())].sum(dtype=float)
        assert (model.tails(__import__("numpy").array([margin]))[0, -1] >= 0.5 and bool(words(text))) == (doc_id in kept)


def test_line_stage(stages):
    rows = plain(stages["quality_classifier"])
    source = {r[0]: r[2] for r in rows}
    want = [(i, text, source[i]) for i, n, gone, text in brute_lines(rows) if gone == 0 or gone < n]
    assert sorted(plain(stages["line_dedup"])) == sorted(want)
    assert stages["line_dedup"].filter(F.char_length("text") != F.col("n_chars")).count() == 0


def sets_of(texts):
    out = []
    for t in texts:
        w = words((t or "").lower())
        out.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))})
    return out


def similar_roots(sets):
    links = [(a, b) for a in range(len(sets)) for b in range(a) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    return brute_components(range(len(sets)), links)


def test_near_duplicate_stage(stages):
    rows = sorted(plain(stages["line_dedup"]))
    root = similar_roots(sets_of(t for _, t, _ in rows))
    want = [r for k, r in enumerate(rows) if root[k] == k]
    assert sorted(plain(stages["simhash_near_dedup"])) == want and len(want) < len(rows)


def test_near_duplicate_stage_by_jaccard(spark, sf):
    """Lightly edited copies go, less similar texts stay, as by brute force over all pairs."""
    rng = random.Random(3)

    def edited(base, n):
        own = list(base)
        for at in rng.sample(range(len(own)), n):
            own[at] = f"x{rng.random()}"
        return " ".join(own)

    bases = [[str(rng.randrange(10**6)) for _ in range(n)] for n in (60, 150, 300, 700)]
    texts = [" ".join(b) for b in bases] + [edited(b, n) for b in bases for n in (1, 2, 3, 5, 8, 12, 20) for _ in range(3)]
    texts += [edited(bases[2], 2) for _ in range(60)] + [None, "", " \n", "a b", "A  b", "a b c", " ".join(bases[0]).upper()]
    root = similar_roots(sets_of(texts))
    first = {}
    for k in range(len(texts)):
        first.setdefault(root[k], k)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    out = sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, sf).collect())
    assert out == sorted(first.values()) and 20 < len(out) < len(texts) - 60


def test_decontamination_stage(spark, sf, stages):
    items = [(r.item_id, r.text) for r in queries.table(spark, sf, "benchmark").collect()]
    rows = plain(stages["simhash_near_dedup"])
    bad = {h[0] for h in brute_hits(rows, items) if h[-1]}
    assert sorted(plain(stages["benchmark_decontamination"])) == sorted(r for r in rows if r[0] not in bad)


def test_mix_stage(stages):
    rows = plain(stages["benchmark_decontamination"])
    sizes, target = brute_targets(rows)
    out = stages["source_mix"].collect()
    taken, copies, largest = Counter(), Counter(), Counter()
    known = {r[0]: r for r in rows}
    for r in out:
        assert known[r.doc_id][1:] == (r.text, r.source)
        taken[r.source] += len(words(r.text))
        copies[r.doc_id] += 1
    for _, text, source in rows:
        largest[source] = max(largest[source], len(words(text)))
    assert max(copies.values()) <= 2 and all(abs(taken[s] - target[s]) <= largest[s] for s in sizes)
    assert {(r.doc_id, r.copy) for r in out} == {(d, k + 1) for d, n in copies.items() for k in range(n)}


def odd(spark):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, copy int, _key bigint, _row string, _grade string"
    text = "the same words again and again in many lines\nof this text\nwith a third line\nand a fourth"
    rows = [(1, None), (2, ""), (None, text), (None, text), (3, text), (3, text), (4, "x " * 5000), (5, "\n\n\n\n"), (None, None)]
    return spark.createDataFrame([(i, t, None, s, 1, 2, None, "r", "g") for (i, t), s in zip(rows, ["a", None, "b", "b", "a", "a", "", None, None])], schema)


@pytest.mark.parametrize("number", range(5))
def test_stages_take_odd_rows_and_empty_tables(spark, sf, number):
    _, stage = corpus_pipeline.STAGES[number]
    for docs in (odd(spark), odd(spark).limit(0)):
        out = stage(spark, docs, sf)
        assert out.columns[: len(docs.columns)] == docs.columns
        rows = out.collect()
        if number == 2 and docs.count():
            texts = [(r.doc_id, r.text) for r in rows]
            assert len(texts) == len(set(texts)) < docs.count()
        if number == 4 and docs.count():
            assert out.columns[-1] == "_copy" and rows


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, sf, name):
    assert compare(spark, duck(sf), sf, name, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_personal_data_query(spark, sf):
    texts = {r.doc_id: r.text for r in queries.table(spark, sf, "documents").collect()}
    for r in entry.queries()["op9_personal_data"](spark, sf).collect():
        want = brute_base(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w[0] == k for w in want) for k in ("email", "ip", "card", "phone")]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest() and r.spans.startswith(joined)


def test_license_query(spark, sf):
    texts = {r.doc_id: r.text for r in queries.table(spark, sf, "documents").collect()}
    found = 0
    for r in entry.queries()["op7_license_scan"](spark, sf).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_places(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        found += r.n_base
    assert found


def test_chat_query(spark, sf):
    rows = [tuple(r) for r in queries.table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-1, k, r, "</s>[INST] ok [/INST]") for k, r in enumerate(("user", "assistant"))]
    out = entry.queries()["op8_chat_windows"](spark, sf).drop("formatted_chars").collect()
    assert sorted(map(tuple, out)) == sorted(brute_chat(rows))


def test_queries_are_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{k}" for k in range(1, 14)} and set(queries.QUERIES) < set(names) and "pipeline" in names
