"""The registered queries against their SQL or plain versions, and the pipeline stage by stage."""

import re
import sys
import zlib
from collections import Counter
from html import unescape
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402
from compare import compare, duck  # noqa: E402
from conftest import SF_DIR  # noqa: E402
from messy import DOCUMENTS, documents, prose, repeated  # noqa: E402
from test_tokens import check_packing  # noqa: E402

import corpus_pipeline  # noqa: E402
from cashline.llm.common import settled, table  # noqa: E402
from cashline.llm.queries import all_queries  # noqa: E402
from cashline.llm.sql import all_oracles  # noqa: E402

QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF_DIR, "documents").orderBy("doc_id").collect()


def test_there_is_a_query_for_each_operator():
    assert [int(m[1]) for name in QUERIES if (m := re.match(r"op(\d+)_", name))] == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_match_their_sql(spark, name):
    assert compare(QUERIES[name](spark, SF_DIR), duck(SF_DIR), ORACLES[name]) is None


def test_op1_gives_the_ids_of_the_tokenizer(spark, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op1_token_files"](spark, SF_DIR).collect()}
    start = 0
    for r in docs:
        ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4")
        assert found.pop(r.doc_id) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert not found


def test_op2_gives_the_article(spark):
    found = {r.page_id: r for r in QUERIES["op2_wrappers"](spark, SF_DIR).collect()}
    pages = table(spark, SF_DIR, "pages").collect()
    for page in pages:
        article = re.search("<article>(.*)</article>", page.html, re.S)[1]
        blocks = [" ".join(unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        text = "\n".join(b for b in blocks if b)
        assert (found[page.page_id].text, found[page.page_id].n_chars, found[page.page_id].url) == (text, len(text), page.url)
    assert len(found) == len(pages)


def test_op5_packs_all_documents(spark, docs):
    found = QUERIES["op5_best_fit_packing"](spark, SF_DIR).collect()
    n = check_packing(docs, found, 1024)
    assert n <= 1.03 * -(-sum(r.length for r in found) // 1024) + 1


def test_op10_gives_the_components(spark, docs):
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op10_minmax_dedup"](spark, SF_DIR).collect()}
    assert found == {r.doc_id: e for r, e in zip(docs, brute.near_groups([(r.doc_id, r.text) for r in docs]))}


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plain_stages(rows, items):
    """The rows that each filtering stage should leave, rows as in `documents`."""
    out = []

    def fails(text):
        n, chars, symbols, marks, lines, doubles, repeats = brute.measured(text)
        return (
            n < 10 or 100 * repeats > 20 * n or 100 * symbols > 10 * chars or 100 * doubles > 50 * lines
            or 100 * marks > 15 * chars or chars > 40 * n
        )

    rows = [r for r in rows if not fails(r[1])]
    out.append(rows)
    order = lambda r: (r[0] is not None, r[0])
    left = brute.deduplicated({r[0]: r[1] for r in sorted(rows, key=order)})
    rows = [r if left[r[0]] == r[1] else (r[0], left[r[0]], *r[2:4], len(left[r[0]])) for r in rows]
    rows = [r for r in rows if brute.white_words(r[1])]
    out.append(rows)
    groups = brute.near_groups([r[:2] for r in rows])
    rows = [r for r, (_, least) in zip(rows, groups) if r[0] == least]
    out.append(rows)
    rows = [r for r in rows if not brute.contamination(r[1], items)[1]]
    out.append(rows)
    return out


def check_stages(spark, docs, sf_dir, rows, items):
    expected = plain_stages(rows, items)
    for (name, stage), want in zip(corpus_pipeline.STAGES, expected):
        docs = settled(stage(spark, docs, sf_dir), "test-stage")
        assert docs.columns == list(corpus_pipeline.DOCUMENT)
        assert rows_of(docs) == sorted(want, key=repr), name
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    check_packing(expected[-1], pieces, 1024)
    return pieces


def test_pipeline_over_the_test_tables(spark, docs):
    items = [tuple(r) for r in table(spark, SF_DIR, "benchmark").collect()]
    pieces = check_stages(spark, table(spark, SF_DIR, "documents"), SF_DIR, [tuple(r) for r in docs], items)
    whole = corpus_pipeline.run(spark, SF_DIR).collect()
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert Counter(map(key, whole)) == Counter(map(key, pieces))


@pytest.mark.parametrize("kind", ["documents", "repeated", "empty"])
def test_pipeline_over_messy_tables(spark, tmp_path, kind):
    rows = {"documents": documents(), "repeated": repeated(), "empty": []}[kind]
    items = [(1, prose(9, 60, 60)), (2, " ".join(prose(3, 90).split()[5:20])), (3, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    check_stages(spark, spark.createDataFrame(rows, DOCUMENTS), str(tmp_path), [r[:5] for r in rows], items)


def test_pipeline_drops_hits_of_items_without_an_id(spark, tmp_path):
    items = [(None, prose(9, 60, 60)), (2, "nowhere to be found at all in any of these texts here")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = corpus_pipeline.clean_of_benchmark(spark, spark.createDataFrame(documents(), DOCUMENTS), str(tmp_path))
    assert {r[0] for r in documents()} - {r.doc_id for r in left.collect()} == {5, 6}


def test_clean_documents_pass_all_stages(spark):
    labels = {r.doc_id for r in table(spark, SF_DIR, "labels").filter("quality = 1").collect()}
    documents = {r.doc_id: r.text for r in table(spark, SF_DIR, "documents").collect()}
    left = corpus_pipeline.quality(spark, table(spark, SF_DIR, "documents"), SF_DIR)
    gone = labels - {r.doc_id for r in left.select("doc_id").collect()}
    assert all(brute.measured(documents[d])[0] < 10 or 5 * brute.measured(documents[d])[6] > brute.measured(documents[d])[0] for d in gone)
