from collections import defaultdict

import duckdb
import pytest

from granary.llm import line_dedup, queries
from tests.llm.cases import DOCS, awkward, rows_of, with_clashes


@pytest.mark.parametrize("lg_k", [4, 10])
def test_lines_by_distinct_sites(spark, lg_k):
    """Spreads all around the threshold; many documents of one site count once."""
    rows, doc = [], 0
    for spread in range(1, 25):
        for copy in range(30):
            doc += 1
            rows.append((doc, f"line number {spread} again\nown text of {doc} here", "en", f"s{copy % spread}", 0))
    docs = spark.createDataFrame(rows, DOCS)
    gone = defaultdict(set)
    for r in line_dedup.spread(docs, 10, 3, lg_k=lg_k).collect():
        gone[r.key].add(r.id)
    assert len(gone) == 15  # spreads from 10 to 24
    assert all(len(ids) == 29 for ids in gone.values())  # the first document keeps the line


def test_query_as_in_sql(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    got = queries.op6_line_dedup(spark, sf_dir)
    columns = sorted(got.columns)
    expected = con.sql(queries.ORACLE_SQL["op6_line_dedup"])
    place = [expected.columns.index(c) for c in columns]
    assert rows_of(got.select(columns)) == sorted((tuple(r[k] for k in place) for r in expected.fetchall()), key=repr)


def test_awkward_rows(spark):
    docs = awkward(spark)
    extra = spark.createDataFrame([(100 + k, "the same old line\nno " + str(k), "en", f"s{k}", 0) for k in range(12)] +
                                  [(200, "the same old line", "en", None, 0), (None, "the same old line", "en", "z", 0), (105, "the same old line", "x", "y", 0)], DOCS)
    both = with_clashes(docs.unionAll(extra))
    got = line_dedup.remove_boilerplate(both, 10)
    assert got.columns == [*both.columns, "lines_before", "lines_removed"]
    by = defaultdict(list)
    for r in got.collect():
        by[r.doc_id].append(r)
    assert by[100][0].text == "the same old line\nno 0" and by[101][0].text == "no 1" and by[200][0].text == ""
    assert sorted(r.text for r in by[105]) == ["", "no 5"]
    assert {r.text for r in by[None]} >= {"the same old line"}
    assert by[3][0].text is None and by[3][0].lines_before == 0 and by[4][0].text == "" and by[5][0].text == " \n\t "
    assert line_dedup.remove_boilerplate(docs.limit(0)).collect() == []
