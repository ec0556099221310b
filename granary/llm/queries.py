"""Queries that apply each operator to its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm import byte_bpe, decontamination, fertility, language_id, licenses, line_dedup, merkle, ngram_join, packing, quality_ranking, recurrent_lm, toxicity, whitening
from granary.llm.common import as_bytes, in_bucket, table


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.similar_documents(table(spark, sf_dir, "documents"), 4, 85)
    return found.withColumnRenamed("component", "component_id")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = in_bucket("doc_id", 3, 1)
    model = language_id.fit(docs.where(~held_out))
    return (docs.select("doc_id", held_out.alias("held_out"), language_id.predict(model, docs, F.col("text")).alias("p"))
            .select("doc_id", "held_out", "p.lang_pred", "p.score"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op4_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    leaks = decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return leaks.withColumnsRenamed({"id": "doc_id", "item": "item_id"})


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove_boilerplate(table(spark, sf_dir, "documents")).select("doc_id", "text", "lines_before", "lines_removed")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", licenses.scan(F.col("text")).alias("s")).select("doc_id", "s.*")


def op7_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_ranking.measured(table(spark, sf_dir, "documents"))
    model = quality_ranking.fit_measured(rows, table(spark, sf_dir, "labels"), 4, 2)
    return (rows.select(F.col("id").alias("doc_id"), in_bucket("id", 4, 2).alias("held_out"), quality_ranking.score(model, F.col("x")).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.7).cast("int")))


def op8_fertility_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.judge(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), 5, 0)
    return (docs.select("doc_id", in_bucket("doc_id", 5, 0).alias("held_out"), toxicity.predict(model, as_bytes("text")).alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def op10_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent_lm.score_documents(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns, tampered = ["doc_id", "source", "lang", "n_chars", "text"], in_bucket("doc_id", 5, 0)
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    altered = F.when(tampered, merkle.leaf([lowered if c == "text" else F.col(c) for c in columns]))
    found = merkle.manifest(table(spark, sf_dir, "documents"), columns, "source", "doc_id", {"altered": altered})
    return (found.select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("witness")).alias("proof_sha256"),
                         merkle.folded(F.coalesce("altered", "leaf"), F.col("witness")).alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"), 4, 256)
    # A deviation that no long holds, as from some hundred million vectors on, is null here; the operator gives it.
    return found.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = table(spark, sf_dir, "documents").select("doc_id", byte_bpe.encode(F.col("text")).alias("ids"))
    both = coded.select("doc_id", "ids", byte_bpe.decode(F.col("ids")).alias("decoded"))
    return both.select("doc_id", F.expr("cast(length(ids) div 4 as bigint)").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def merkle_sql(levels: int = 7, top: int = 3) -> str:
    """op11 in SQL, for pos most 16 ** levels rows a source and 16 ** top sources."""
    crc = ("xor(4294967295::ubigint, list_reduce(list_prepend(4294967295::ubigint, list_transform(string_split(doc_id::varchar, ''), lambda ch: ascii(ch)::ubigint)), "
           "lambda acc, b: list_reduce(list_prepend(xor(acc, b), range(8)::ubigint[]), lambda x, bit: xor(x >> 1, 3988292384::ubigint * (x & 1::ubigint)))))")
    text = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    part = lambda f: f"case when {f} is null then '-' else strlen({f}::varchar)::varchar || ':' || {f}::varchar end"
    leaf = lambda t: "sha256(" + " || ".join(map(part, ("doc_id", "source", "lang", "n_chars", t))) + ")"
    # a: the nodes of a level, s: its runs of siblings; g is null in the tree of all sources.
    steps = [f"d as (select doc_id, source, {leaf('text')} as leaf, coalesce({crc} % 5 = 0, false) as tampered, {leaf(text)} as other from documents)",
             "p as (select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by source) as n from d)",
             "a0 as (select source as g, pos, leaf as node, n from p)"]
    for k in range(levels + top):
        if k == levels:
            steps.append(f"t as (select g as source, node as subroot, row_number() over (order by g nulls first) - 1 as tree, count(*) over () as sources from a{k})")
            steps.append(f"b{k} as (select null::varchar as g, tree as pos, subroot as node, sources as n from t)")
        of = f"b{k}" if k >= levels else f"a{k}"
        to = f"b{k + 1}" if k >= levels else f"a{k + 1}"
        steps.append(f"s{k} as (select g, pos // 16 as run, string_agg(node, '' order by pos) as whole, max(n) as n from {of} group by g, pos // 16)")
        steps.append(f"{to} as (select g, run as pos, case when n = 1 then whole else sha256(whole) end as node, (n + 15) // 16 as n from s{k})")
    now, last = "p0", levels + top
    steps.append("p0 as (select p.doc_id, p.source, p.leaf, p.pos, case when tampered then other else leaf end as h, '' as proof, t.subroot, t.tree "
                 "from p join t on p.source is not distinct from t.source)")
    for k in range(last):
        place = f"(p.pos // {16 ** k})" if k < levels else f"(p.tree // {16 ** (k - levels)})"
        same = "s.g is not distinct from p.source" if k < levels else "true"
        left, right = f"left(s.whole, 64 * ({place} % 16))", f"substr(s.whole, 64 * ({place} % 16) + 65)"
        steps.append(f"p{k + 1} as (select p.* exclude (h, proof), case when s.n = 1 then h else sha256({left} || h || {right}) end as h, "
                     f"case when s.n = 1 then proof else proof || {left} || {right} end as proof from {now} p join s{k} s on {same} and s.run = {place} // 16)")
        now = f"p{k + 1}"
    return (f"with {', '.join(steps)} select doc_id, leaf, subroot, node as root, sha256(proof) as proof_sha256, h as folded_root, h = node as verified "
            f"from {now}, b{last}")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q for q in (op1_ngram_join, op2_language_id, op3_best_fit_packing, op4_template_decontamination, op5_license_scan,
                            op6_line_dedup, op7_quality_ranking,
                            op8_fertility_rules, op9_toxicity, op10_recurrent_lm, op11_merkle_manifest,
                            op12_whitening, op13_byte_bpe)}
ORACLE_SQL: dict[str, str] = {
    "op11_merkle_manifest": merkle_sql(),
    "op6_line_dedup": """
        with d as (select doc_id, source, text, string_split(text, chr(10)) as parts from documents),
        l as (select doc_id, source, unnest(parts) as line, generate_subscripts(parts, 1) as pos from d),
        k as (select *, trim(line) as key, regexp_matches(line, '\\S\\s+\\S+\\s+\\S') as long_enough from l),
        b as (select key, min(doc_id) as first from k where long_enough group by key having count(distinct source) >= 10),
        m as (select k.*, b.key is not null and k.long_enough and k.doc_id <> b.first as gone from k left join b using (key))
        select doc_id, coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '') as text,
               count(*)::bigint as lines_before, count(*) filter (where gone)::bigint as lines_removed
        from m group by doc_id
    """,
}
