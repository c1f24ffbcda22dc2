"""Every query of these operators: its rows against its SQL in another engine, or against a plain program."""

import hashlib
import re
from collections import Counter
from pathlib import Path

import pytest
import public_tokenizers

import __spark_entry__ as contract
from visitloom.llm.oracle import ORACLE
from visitloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = "documents embeddings benchmark labels".split()
needs_data = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def test_registered():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert set(ORACLE) <= set(contract.oracle_sql())


@pytest.fixture(scope="module")
def tables():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def _plain(row):
    return tuple(tuple(x) if isinstance(x, list) else x for x in row)


@needs_data
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_rows_equal_sql(spark, tables, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = Counter(_plain(r) for r in df.select(*(f"`{c}`" for c in columns)).collect())
    listed = ", ".join(f'"{c}"' for c in columns)
    assert got == Counter(map(_plain, tables.execute(f"SELECT {listed} FROM ({ORACLE[name]}) q").fetchall()))


@needs_data
def test_token_counts_are_the_librarys(spark, tables):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = dict(tables.execute("SELECT doc_id, text FROM documents").fetchall())
    got = {r["doc_id"]: r for r in QUERIES["op3_token_counts"](spark, FOLDER).collect()}
    assert got.keys() == texts.keys()
    for doc_id, text in texts.items():
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids)
        assert got[doc_id]["n_tokens"] == n and got[doc_id]["over_limit"] == (n > 1024)
        assert got[doc_id]["n_bytes"] == len((text or "").encode())


def _held_out(doc_id):
    import zlib

    return zlib.crc32(str(doc_id).encode()) % 4 == 2


@needs_data
def test_languages_of_texts_held_out(spark, tables):
    langs = dict(tables.execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = QUERIES["op6_language_id"](spark, FOLDER).collect()
    assert {r["doc_id"] for r in rows} == set(langs)
    assert all(r["held_out"] == _held_out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)
    held = [r["lang_pred"] == langs[r["doc_id"]] for r in rows if r["held_out"]]
    assert sum(held) / len(held) > 0.9


@needs_data
def test_toxicity_of_texts_held_out(spark, tables):
    folder = "/root/testdata/sf0.1"
    labels = dict(tables.execute(f"SELECT doc_id, toxic FROM '{folder}/labels.parquet'").fetchall())
    rows = QUERIES["op4_toxicity"](spark, folder).collect()
    assert all(r["held_out"] == _held_out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    found = Counter(held)
    assert found[1, 1] / (found[1, 1] + found[0, 1]) > 0.85
    assert found[1, 0] / (found[1, 0] + found[0, 0]) < 0.02


@needs_data
def test_encoding_round_trip(spark, tables):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = dict(tables.execute("SELECT doc_id, text FROM documents").fetchall())
    for r in QUERIES["op8_sentencepiece"](spark, FOLDER).collect():
        assert r["ids"] == model.encode(texts[r["doc_id"]]) and r["n_tokens"] == len(r["ids"])
        assert r["parity"] and r["round_trip"] and r["decoded"] == texts[r["doc_id"]]


@needs_data
def test_pseudonyms_against_a_plain_program(spark, tables):
    from tests.llm.test_pii import pseudonymised

    texts = dict(tables.execute("SELECT doc_id, text FROM documents").fetchall())
    changed = 0
    for r in QUERIES["op10_pii"](spark, FOLDER).collect():
        expected = pseudonymised(texts[r["doc_id"]], "registered-query")
        assert r["text"] == expected
        changed += expected != texts[r["doc_id"]]
    assert changed > 5


@needs_data
def test_pipeline(spark, tables):
    """What is left has no repeated line, no near-duplicate and no passage of the benchmark, and is encoded as it is."""
    rows = contract.queries()["pipeline"](spark, FOLDER).collect()
    texts = {r["doc_id"]: r["decoded"] for r in rows}
    assert len(texts) == len(rows) and all(r["parity"] and r["round_trip"] for r in rows)
    given = dict(tables.execute("SELECT doc_id, text FROM documents").fetchall())
    lines = Counter(" ".join(line.split()) for text in texts.values() for line in text.split("\n") if line.strip())
    assert max(lines.values()) == 1 or sum(n > 1 for n in lines.values()) < 5  # cut passages may leave equal rests
    words = {i: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.lower()) for i, t in texts.items()}
    windows = set()
    for (text,) in tables.execute("SELECT text FROM benchmark").fetchall():
        item = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
        windows |= {tuple(item[i : i + 10]) for i in range(max(1, len(item) - 9))}
    assert not any(tuple(w[i : i + 10]) in windows for w in words.values() for i in range(len(w) - 9))
    shingles = {i: {hashlib.md5(" ".join(t.lower().split()[k : k + 5]).encode()).digest() for k in range(max(1, len(t.split()) - 4))}
                for i, t in texts.items()}
    ids = sorted(shingles)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            assert 100 * len(shingles[i] & shingles[j]) < 75 * len(shingles[i] | shingles[j])
    # What is left of a text are words of the text.
    for i, left in words.items():
        assert not Counter(left) - Counter(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", given[i].lower()))
