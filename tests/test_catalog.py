"""Every core query against its SQL; the few without by their values."""

import os

import pytest

from corpuslake.plans import catalog

from .oracle import FOLDER, both

pytestmark = pytest.mark.skipif(not os.path.exists(FOLDER), reason="no test tables here")


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_is_its_sql(spark, name):
    got, want = both(spark, catalog.QUERIES[name], catalog.SQL[name])
    assert got == want


def test_what_has_no_sql():
    assert set(catalog.QUERIES) - set(catalog.SQL) == {"subsection_tree", "vector_index_topk"}
    assert set(catalog.SQL) <= set(catalog.QUERIES) and all(catalog.SQL.values())


def test_subsection_tree_holds_every_marked_part(spark):
    from corpuslake.operators.documents import subsections

    got = {}
    for r in catalog.QUERIES["subsection_tree"](spark, FOLDER).collect():
        got.setdefault(r.doc_id, []).append((r.path, r.depth, r.kind))
    docs = spark.read.parquet(FOLDER + "/documents.parquet").collect()
    assert {d.doc_id: sorted((x["path"], x["depth"], x["kind"]) for x in subsections(d.text)) for d in docs} == {k: sorted(v) for k, v in got.items()}


def test_flagship(spark):
    assert catalog.flagship(spark, FOLDER).count() > 0
