"""The pipeline, stage by stage, against plain versions on a small corpus with planted cases."""

import random
from collections import Counter

import corpus_pipeline
from siltmill.llm import decontam, quality


def corpus(seed=5):
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in ("", "n", "r", "st", "l")]
    prose = lambda n: "\n".join(" ".join(rng.choices(words, k=12)) + "." for _ in range(n))
    item = " ".join(rng.choices(words, k=30))
    rows, i = [], 0

    def put(text, kind):
        nonlocal i
        rows.append((i, text, "en", f"site{i % 12}", None if text is None else len(text), kind))
        i += 1

    shared = prose(1)
    for _ in range(60):
        put(prose(rng.randint(2, 8)), "clean")
    for _ in range(15):
        put(prose(3) + "\n" + shared + "\n" + prose(1), "boilerplate")
    copy = prose(20)
    for _ in range(4):
        put(copy, "copy")
    edited = copy.split(" ")
    edited[7] = edited[90] = "edited"
    put(" ".join(edited), "copy")
    put(prose(2) + "\n" + item + "\n" + prose(2), "leak")
    put(("spam spam ham " * 40).strip(), "repeats")
    put("too short", "short")
    put(None, "null")
    put("", "empty")
    put(prose(600), "long")
    return rows, item, shared


def similarity(a, b):
    x, y = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a.lower().split(), b.lower().split()))
    return len(x & y) / len(x | y)


def test_pipeline_stages(spark, tmp_path):
    rows, item, shared = corpus()
    base = f"file://{tmp_path}"
    spark.createDataFrame([r[:5] for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(r[0], int(r[5] not in ("repeats", "short")), 0) for r in rows if r[0] % 2 or r[5] == "repeats"], "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    kind = {r[0]: r[5] for r in rows}
    docs = spark.read.parquet(f"{base}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, base)
        path = f"{base}/{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns, name
            kept.append({r.doc_id: r.text for r in docs.collect()})
    first, second, third, fourth = kept
    texts = {r[0]: r[1] for r in rows}
    base_ok = {i for i, t in texts.items() if quality.statistics(t)[0][0] >= 10 and 100 * quality.statistics(t)[0][4] <= 20 * quality.statistics(t)[0][0]}
    assert set(first) <= base_ok and {i for i, k in kind.items() if k in ("clean", "boilerplate", "copy", "leak", "long")} <= set(first)
    assert not {i for i, k in kind.items() if k in ("repeats", "short", "null", "empty")} & set(first)
    with_shared = [i for i in sorted(first) if shared in first[i].split("\n")]
    assert [i for i in second if shared in second[i].split("\n")] == with_shared[:1]
    assert all(second[i] == first[i] for i in second if i not in with_shared) and set(second) == set(first)
    gone = set(second) - set(third)
    assert gone == {i for i in second if any(j < i and similarity(second[i], second[j]) >= 0.8 for j in second)}
    assert sum(kind[i] == "copy" for i in third) == 1
    assert {kind[i] for i in set(third) - set(fourth)} == {"leak"} and all(kind[i] != "leak" for i in fourth)
    packed = docs.collect()
    assert {r.doc_id for r in packed} == set(fourth)
    filled = Counter()
    for r in sorted(packed, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled[r.sequence_id]
        filled[r.sequence_id] += r.length
    assert max(filled.values()) <= 2048
    again = corpus_pipeline.run(spark, base).collect()
    assert Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in again) == Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in packed)
    assert decontam.Seeds().masks


def awkward():
    prose = "\n".join(" ".join(f"w{(i * 7 + j * j) % 211}x{j}" for j in range(12)) for i in range(8))
    other = prose.replace("w1", "v2").replace("x3", "z9")
    long = " ".join(f"long{i}" for i in range(30000))
    return [
        ("b", prose, "en", "s1", 7, 1, "n", 5), ("a", prose, None, None, None, 2, None, None), ("a", prose, None, None, None, 2, None, None), ("a", other, "en", "s2", 1, 3, "x", 1),
        (None, prose, "en", "s1", 1, 4, "x", 1), (None, other + " end of it", "en", "s1", 1, 4, "x", 1), ("c", None, "en", "s1", None, 1, "x", 1), ("d", "", "en", "s1", 0, 1, "x", 1), ("e", " \t\n", None, "s1", 3, 1, "x", 1),
        ("f", long, "en", "s1", 1, 1, "x", 1), ("g", "one two", "en", "s1", 1, 1, "x", 1),
    ]


def test_stages_take_awkward_rows(spark, tmp_path):
    base = f"file://{tmp_path}"
    schema = "doc_id string, text string, lang string, source string, n_chars long, n_removed int, fp string, k1 int"
    docs = spark.createDataFrame(awkward(), schema)
    spark.createDataFrame([("a", 1, 0), (None, 0, 0), ("zz", None, 0)], "doc_id string, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame([(1, "never to be found in any of these texts at all, not even once"), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    rows = lambda df: sorted(map(repr, df.collect()))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, base)
        assert out.columns == docs.columns, name
        got, n = out.collect(), Counter(map(repr, out.collect()))
        if name == "quality rules":
            assert {r.doc_id for r in got} == {"a", "b", None, "f"} and sum(r.doc_id == "a" for r in got) == 3
        if name in ("line dedup", "benchmark decontamination"):
            assert [(r.doc_id, r.text, r.n_removed, r.fp, r.k1) for r in sorted(got, key=repr)] == [(r.doc_id, r.text, r.n_removed, r.fp, r.k1) for r in sorted(docs.collect(), key=repr)]
        if name == "SimHash near-dedup":
            prose, other = awkward()[0][1], awkward()[3][1]
            assert sorted((str(r.doc_id), r.text) for r in got) == sorted([("a", prose), ("a", other), ("c", None), ("f", awkward()[9][1]), ("g", "one two")])
            assert max(n.values()) == 1
        empty = stage(spark, docs.limit(0), base)
        assert empty.columns == docs.columns and rows(empty) == []
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, base).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(r[0] for r in awkward())
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), base).count() == 0
