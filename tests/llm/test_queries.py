"""The registered queries on the smallest tables: against SQL, or against plain Python where SQL ends."""

import hashlib
import zlib

import numpy as np
import pytest
from tests.llm import test_operators as plain

from siltmill.llm import registry, tokencount

BASE = "/root/testdata/sf0.001"
TABLES = "documents pages benchmark labels".split()


@pytest.fixture(scope="module")
def texts():
    import pyarrow.parquet as pq

    t = pq.read_table(f"{BASE}/documents.parquet").to_pydict()
    return dict(zip(t["doc_id"], zip(t["text"], t["lang"], strict=True), strict=True))


def result(spark, name):
    return registry.queries()[name](spark, BASE)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{BASE}/{t}.parquet'")
    found = con.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    df = result(spark, name)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(repr, (tuple(r[c] for c in columns) for r in df.collect()))) == sorted(map(repr, found.fetchall()))


def test_quality_query(spark, texts):
    got = {r.doc_id: r for r in result(spark, "op1_quality").collect()}
    assert got.keys() == texts.keys()
    for i, (text, _) in texts.items():
        r, base = got[i], plain.brute_statistics(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert r.base_failed == (base[0] < 10 or 100 * base[4] > 20 * base[0]) and not (r.kept and r.base_failed)


def test_packing_query(spark, texts):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    encoder, ids = Tokenizer.from_file(P.path("byte_bpe_50k.json")), {}
    for i, (text, _) in texts.items():
        ids[i] = [*encoder.encode(text or "", add_special_tokens=False).ids, 0]
    rows = result(spark, "op2_packing").collect()
    for r in rows:
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert len(piece) == r.length <= 2048 and zlib.crc32(np.array(piece, "<u4").tobytes()) == r.ids_crc32
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    assert len(rows) == sum(-(-len(x) // 2048) for x in ids.values())
    least = -(-sum(map(len, ids.values())) // 2048)
    assert len({r.sequence_id for r in rows}) <= least + 2


def test_secrets_query(spark, texts):
    for r in result(spark, "op5_secrets").collect():
        spans = plain.brute_spans(texts[r.doc_id][0] or "")
        base = [f"{k}:{s}:{e}" for s, e, k in spans]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest() and set(base) <= set(r.spans.split(",")) | {""}
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == x for _, _, k in spans) for x in ("assign", "access", "hex")]


def test_simhash_query(spark, texts):
    prints = {i: plain.brute_print(t) for i, (t, _) in texts.items()}
    groups, least = plain.brute_components(set(prints.values())), {}
    for i, p in sorted(prints.items()):
        least.setdefault(groups[p], i)
    rows = result(spark, "op6_simhash").collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in rows} == {(i, f"{p:016x}", least[groups[p]]) for i, p in prints.items()}
    assert len(rows) == len(texts)


def test_language_query(spark, texts):
    rows = result(spark, "op7_language").collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [r.lang_pred == texts[r.doc_id][1] for r in rows if r.held_out]
    assert len(rows) == len(texts) and sum(held) >= 0.9 * len(held)


def test_token_query(spark, texts):
    import public_tokenizers as P

    model, known = tokencount._model(P.path(tokencount.VOCABULARY)), {}
    for r in result(spark, "op9_tokens").collect():
        words = plain.WORD.findall(texts[r.doc_id][0] or "")
        for w in words:
            if w not in known:
                known[w] = plain.brute_tokens(model, tokencount.MARK + w)
        assert (r.n_pretokens, r.n_tokens) == (len(words), sum(known[w][0] for w in words))
