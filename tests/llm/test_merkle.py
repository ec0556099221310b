import hashlib
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from granary.llm import merkle, queries
from granary.llm.merkle import Appender, height
from tests.llm.cases import DOCS, awkward, rows_of, with_clashes


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(nodes, fan=16):
    """The root, and each node's siblings (before, after) level by level, by the definition."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([sha("".join(now[k:k + fan])) for k in range(0, len(now), fan)])
    paths = []
    for k in range(len(nodes)):
        path, at = [], k
        for now in levels[:-1]:
            first = at - at % fan
            path.append(("".join(now[first:at]), "".join(now[at + 1:first + fan])))
            at //= fan
        paths.append(path)
    return levels[-1][0] if nodes else None, paths


def brute(rows):
    """Rows of the contract from (doc_id, text, lang, source, n_chars)."""
    by, out = defaultdict(list), []
    for doc, text, lang, source, n in rows:
        leaf = sha("".join(map(field, (doc, source, lang, n, text))))
        bad = doc is not None and zlib.crc32(str(doc).encode()) % 5 == 0
        low = text and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        by[source].append((doc is not None, doc or 0, leaf, doc, sha("".join(map(field, (doc, source, lang, n, low)))) if bad else leaf))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    found = {s: tree([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in order}
    root, tops = tree([found[s][0] for s in order])
    for s, up in zip(order, tops, strict=True):
        subroot, paths = found[s]
        for (_, _, leaf, doc, altered), path in zip(sorted(by[s], key=lambda x: x[:3]), paths, strict=True):
            h = altered
            for before, after in path + up:
                h = sha(before + h + after)
            out.append((doc, leaf, subroot, root, sha("".join(b + a for b, a in path + up)), h, h == root))
    return out


def digest_rows(spark, docs, monkeypatch):
    monkeypatch.setattr(queries, "table", lambda *_: docs)
    return rows_of(queries.op11_merkle_manifest(spark, ""))


@pytest.mark.parametrize("size", ["sf0.001", "sf0.1"])
def test_query_over_whole_table(spark, sf_dir, size):
    place = sf_dir.replace("sf0.001", size)
    docs = spark.read.parquet(f"{place}/documents.parquet")
    expected = brute([tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect()])
    found = queries.op11_merkle_manifest(spark, place)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert rows_of(found) == sorted(expected, key=repr)
    assert not all(r[-1] for r in expected)


def test_sql_is_the_definition(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    columns = "doc_id, leaf, subroot, root, proof_sha256, folded_root, verified"
    got = con.sql(f"select {columns} from ({queries.ORACLE_SQL['op11_merkle_manifest']})").fetchall()
    assert sorted(got, key=repr) == sorted(brute([tuple(r) for r in docs.collect()]), key=repr)


@pytest.mark.parametrize("n,fan", [(1, 2), (2, 2), (3, 2), (16, 16), (17, 16), (255, 4), (256, 4), (257, 4), (1000, 3)])
def test_appender(n, fan):
    nodes = [sha(str(k)) for k in range(n)]
    whole, places = Appender(fan), []
    for k, node in enumerate(nodes):
        places.append(whole.append(node))
        # What a partial witness has of the siblings so far is right, and grows.
        first = k - k % fan
        assert whole.witness(places[first])[0] == ("", "".join(nodes[first + 1:k + 1]))
    root, paths = tree(nodes, fan)
    assert whole.close(height(n, fan)) == root
    assert [whole.witness(p, height(n, fan)) for p in places] == paths


def test_block_roots_are_appended_like_nodes():
    """Blocks built apart, their roots appended to one tree: witnesses are joined end to end."""
    nodes = [sha(str(k)) for k in range(150)]
    root, paths = tree(nodes, 4)
    top, found, ups = Appender(4), [], []
    for first in range(0, 150, 16):
        block = Appender(4)
        places = [block.append(x) for x in nodes[first:first + 16]]
        ups.append(top.append(block.close(2)))
        found.append([block.witness(p, 2) for p in places])
    assert top.close(height(150, 4) - 2) == root
    assert [w + top.witness(u, height(150, 4) - 2) for u, ws in zip(ups, found, strict=True) for w in ws] == paths
    with pytest.raises(ValueError):
        Appender(4).close(1)


@pytest.mark.parametrize("fan,levels", [(2, 1), (2, 2), (3, 1), (16, 1)])
def test_many_rounds(spark, fan, levels):
    """A hot group of many rounds and many small groups, in blocks of a few nodes."""
    kinds = ["hot"] * 90 + [f"s{k}" for k in range(40)] + [None] * 5
    rows = [(k, kind, sha(str(k))) for k, kind in enumerate(kinds)]
    found = merkle.with_witnesses(spark.createDataFrame(rows, "id long, kind string, leaf string"), "kind", ["id"], "leaf", fan, levels).collect()
    by = defaultdict(list)
    for k, kind, leaf in rows:
        by[kind].append(leaf)
    order = sorted(by, key=lambda s: (s is not None, s or ""))
    root, tops = tree([tree(by[s], fan)[0] for s in order], fan)
    expected = {leaf: (tree(by[s], fan)[0], root, path + up) for s, up in zip(order, tops, strict=True) for leaf, path in zip(by[s], tree(by[s], fan)[1], strict=True)}
    assert {r.leaf: (r.subroot, r.root, [tuple(w) for w in r.witness]) for r in found} == expected


def test_awkward_rows(spark, monkeypatch):
    docs = awkward(spark)
    plain = [tuple(r) for r in docs.collect()]
    clashing = with_clashes(docs)
    for name in ("leaf", "tree", "at", "total", "block", "place", "part", "root", "row_id", "tie", "altered"):
        clashing = clashing.withColumn(name, F.lit("extra"))
    assert digest_rows(spark, clashing, monkeypatch) == sorted(brute(plain), key=repr)
    for rows in ([], plain[:1], plain[2:3], [plain[0]] * 300):
        assert digest_rows(spark, spark.createDataFrame(rows, DOCS), monkeypatch) == sorted(brute(rows), key=repr)


def test_tampering_is_found(spark, sf_dir):
    """Any change of a leaf changes the folded root; lower-casing a text without capitals changes nothing."""
    found = queries.op11_merkle_manifest(spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", (F.col("text").rlike("[A-Z]") & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)).alias("changed"))
    both = found.join(docs, "doc_id").groupBy("changed", "verified").count().collect()
    assert {(r.changed, r.verified) for r in both} == {(True, False), (False, True)}
