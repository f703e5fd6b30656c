"""Queries with vectors and TF-IDF."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import graph, scan, tfidf, vectors as op
from ..session import keep, table
from . import base as b
from .registry import Registry

query = Registry()
QUERIES, SQL = query.queries, query.sql
THETA = 0.3
_P = "p as (select x.vec_id as query_id, y.vec_id as vec_id, list_dot_product(x.embedding::double[], y.embedding::double[]) as cosine from embeddings x, embeddings y where x.vec_id % 50 = 0 and x.vec_id <> y.vec_id)"


def _pairs(spark: SparkSession, d: str, theta: float) -> DataFrame:
    e = table(spark, d, "embeddings")
    return op.search(e, e.where("vec_id % 50 = 0"), "vec_id", "embedding", theta)


@query("j8_pairs", b.with_(_P) + f"select query_id, vec_id, round(cosine, 5) as cosine from p where cosine >= {THETA}")
def j8(spark: SparkSession, d: str) -> DataFrame:
    """Vectors near each query vector; the queries are every row whose id is divisible by 50."""
    return _pairs(spark, d, THETA).where(F.col("cosine") >= THETA).select("query_id", "vec_id", F.round("cosine", 5).alias("cosine"))


@query("a11_sim_histogram", b.with_(_P) + "select least(floor(cosine * 10), 9)::bigint as bin, count(*) as pairs from p where cosine >= 0 group by 1")
def a11(spark: SparkSession, d: str) -> DataFrame:
    return op.histogram(_pairs(spark, d, 0.0), "cosine")


@query("a12_threshold_sweep", b.with_(_P, "t as (select unnest([0.2, 0.3, 0.4]::double[]) as theta)") + "select theta, count(*) as edges, count(distinct vec_id) as nodes from p join t on p.cosine >= t.theta group by theta")
def a12(spark: SparkSession, d: str) -> DataFrame:
    return op.sweep(_pairs(spark, d, 0.2), "cosine", [0.2, 0.3, 0.4], "vec_id")


@query("t6_representative", b.with_(_P) + "select query_id, vec_id, round(cosine, 5) as cosine from (select *, row_number() over (partition by query_id order by round(cosine, 9) desc, vec_id) as rn from p) where rn = 1")
def t6(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    near = op.search(e, e.where("vec_id % 50 = 0"), "vec_id", "embedding", -1.0, nearest=True)
    best = F.min_by(F.struct("vec_id", "cosine"), F.struct((-F.round("cosine", 9)).alias("c"), "vec_id"))
    return near.groupBy("query_id").agg(best.alias("x")).select("query_id", "x.vec_id", F.round("x.cosine", 5).alias("cosine"))


@query("a8_cluster_mean", "with n as (select label, count(*) as n from embeddings group by label), p as (select x.label, avg(list_cosine_similarity(x.embedding::double[], y.embedding::double[])) as mean from embeddings x join embeddings y on x.label = y.label and x.vec_id < y.vec_id group by x.label) select n.label, n, round(coalesce(mean, 0), 4) as mean from n left join p on n.label = p.label")
def a8(spark: SparkSession, d: str) -> DataFrame:
    return op.mean_similarity(table(spark, d, "embeddings"), "label", "embedding")


@query("a7_vector_components", b.with_(_P).replace("with ", "with recursive ", 1) + f", e as (select query_id as a, vec_id as b from p where cosine >= {THETA} union select vec_id, query_id from p where cosine >= {THETA}), r as (select a as node, a as seen from e union select r.node, e.b from r join e on r.seen = e.a) select node, min(seen) as component from r group by node")
def a7v(spark: SparkSession, d: str) -> DataFrame:
    pairs = _pairs(spark, d, THETA).where(F.col("cosine") >= THETA)
    return graph.components(pairs.select(F.col("query_id").alias("src"), F.col("vec_id").alias("dst")))


_A = "p as (select x.vec_id as a, y.vec_id as b, list_dot_product(x.embedding::double[], y.embedding::double[]) as cosine from embeddings x join embeddings y on x.vec_id < y.vec_id)"
#: Vectors that are thematically near (the test vectors are random, so few are).
THEMATIC = 0.35
#: Fewest members of a group of thematic pairs.
LEAST_MEMBERS = 3


def _all_pairs(spark: SparkSession, d: str, theta: float) -> DataFrame:
    return op.all_pairs(table(spark, d, "embeddings"), "vec_id", "embedding", theta).where(F.col("cosine") >= theta)


def _reach(where: str) -> str:
    """SQL of the components of some of the pairs."""
    return f"e as (select a, b from p where {where} union select b, a from p where {where}), r as (select a as node, a as seen from e union select r.node, e.b from r join e on r.seen = e.a), k as (select node, min(seen) as component from r group by node)"


@query("j8_all_pairs", b.with_(_A) + f"select a, b, round(cosine, 5) as cosine from p where cosine >= {THETA}")
def j8_all(spark: SparkSession, d: str) -> DataFrame:
    """All vectors near each other, where j8_pairs searches for a query set."""
    return _all_pairs(spark, d, THETA).select("a", "b", F.round("cosine", 5).alias("cosine"))


@query("a11_all_sim_histogram", b.with_(_A) + "select least(floor(cosine * 10), 9)::bigint as bin, count(*) as pairs from p where cosine >= 0 group by 1")
def a11_all(spark: SparkSession, d: str) -> DataFrame:
    return op.histogram(_all_pairs(spark, d, 0.0), "cosine")


@query(
    "t6_all_representative",
    b.with_(_A).replace("with ", "with recursive ", 1)
    + ", "
    + _reach(f"cosine >= {THEMATIC}")
    + f", n as (select component from k group by component having count(*) >= {LEAST_MEMBERS}) select component, a, b, round(cosine, 5) as cosine from (select component, p.*, row_number() over (partition by component order by round(cosine, 9) desc, a, b) as rn from p join k on k.node = p.a join n using (component) where cosine >= {THEMATIC}) where rn = 1",
)
def t6_all(spark: SparkSession, d: str) -> DataFrame:
    """The strongest thematic pair of each group of three or more vectors that thematic pairs connect."""
    pairs = keep(_all_pairs(spark, d, THEMATIC).where(F.col("cosine") >= THEMATIC))
    groups = graph.components(pairs, "a", "b")
    large = groups.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_MEMBERS).select("component")
    best = F.min_by(F.struct("a", "b", "cosine"), F.struct((-F.round("cosine", 9)).alias("c"), "a", "b"))
    inside = pairs.join(groups.withColumnRenamed("node", "a"), "a").join(large, "component")
    return inside.groupBy("component").agg(best.alias("x")).select("component", "x.a", "x.b", F.round("x.cosine", 5).alias("cosine"))


@query("a7_all_vector_components", b.with_(_A).replace("with ", "with recursive ", 1) + ", " + _reach(f"cosine >= {THETA}") + " select vec_id as node, coalesce(component, vec_id) as component from embeddings left join k on node = vec_id where embedding is not null")
def a7v_all(spark: SparkSession, d: str) -> DataFrame:
    """One row a vector with its component over the links between all vectors."""
    return op.classes(table(spark, d, "embeddings"), _all_pairs(spark, d, THETA), "vec_id", "embedding")


@query("a12_all_threshold_clusters")
def a12_all(spark: SparkSession, d: str) -> DataFrame:
    """Clusters, largest and mean size and unsorted share at each threshold, over the links of all vectors."""
    return op.simulate(table(spark, d, "embeddings"), _all_pairs(spark, d, 0.2), "vec_id", "embedding", [0.2, 0.3, 0.4])


#: Least similarity of texts that count as near-duplicates, terms of the vocabulary, and documents a term needs.
EDGE, VOCABULARY, LEAST_DOCS = 0.72, 20_000, 2


def _tfidf(texts: str) -> str:
    """SQL of the edges of texts (text, id), given as a common table expression d."""
    return ", ".join(
        [
            texts,
            "ws as (select id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}') as ws from d)",
            "tf as (select id, term, count(*) as tf from (select id, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) as term from ws) group by 1, 2)",
            f"df as (select term, count(*) as df from tf group by 1 having count(*) >= least({LEAST_DOCS}, greatest(1, (select count(*) // 10 from d))) order by sum(tf) desc, term limit {VOCABULARY})",
            "raw as (select id, term, df, (1 + ln(tf::double)) * (ln((1.0 + (select count(*) from d)) / (1.0 + df)) + 1) as raw from tf join df using (term))",
            "ln_ as (select id, sqrt(sum(raw * raw)) as length from raw group by 1)",
            "v as (select raw.id, term, df, raw / length as w from raw join ln_ on raw.id = ln_.id)",
            f"pre as (select id, term from (select *, sum(w * w) over (partition by id order by df desc, term desc rows between unbounded preceding and current row) as rest from v) where rest >= {EDGE * EDGE - 1e-9})",
            "cand as (select distinct x.id as a, y.id as b from pre x join pre y on x.term = y.term and x.id < y.id)",
            f"edges as (select a, b, round(sum(x.w * y.w), 4) as similarity from cand join v x on x.id = a join v y on y.id = b and y.term = x.term group by 1, 2 having sum(x.w * y.w) >= {EDGE})",
        ]
    )


_T = _tfidf(b.G + ", d as (select text, min(segment_id) as id from g where text is not null group by text)")


def _texts(spark: SparkSession, d: str) -> DataFrame:
    """Sections of every length; equal texts are one, named by their first id."""
    return b.segments(spark, d).where("text is not null").groupBy("text").agg(F.min("segment_id").alias("id"))


def _near(texts: DataFrame) -> DataFrame:
    return tfidf.similar_texts(texts, "id", "text", EDGE, LEAST_DOCS, VOCABULARY)


def _edges(spark: SparkSession, d: str) -> DataFrame:
    return tfidf.similar_texts(_texts(spark, d), "id", "text", EDGE, LEAST_DOCS, VOCABULARY).withColumn("similarity", F.round("similarity", 4))


@query("j6_near_dups", "with " + _T + " select a, b, similarity from edges")
def j6(spark: SparkSession, d: str) -> DataFrame:
    """Similar sections of any length."""
    return _edges(spark, d)


_SIM = "case when similarity >= 1.0 then '1.00' when similarity >= 0.9 then '>=0.90' when similarity >= 0.8 then '>=0.80' else '<0.80' end"


@query("pj11_sim_bins", "with " + _T + f" select {_SIM} as bin, count(*) as edges from edges group by 1")
def p11(spark: SparkSession, d: str) -> DataFrame:
    return _edges(spark, d).groupBy(F.expr(_SIM).alias("bin")).agg(F.count("*").alias("edges"))


@query("t2_top_edges", "with " + _T + " select a, b, similarity from edges order by similarity desc, a, b limit 10")
def t2(spark: SparkSession, d: str) -> DataFrame:
    return _edges(spark, d).orderBy(F.desc("similarity"), "a", "b").limit(10)


@query("f30_tfidf_top", "with " + _T + ", o as (select id, term, round(w, 6) as w, row_number() over (partition by id order by round(w, 9) desc, term) as rn from v) select id, term, w from o where rn <= 3")
def f30(spark: SparkSession, d: str) -> DataFrame:
    v = tfidf.weights(_texts(spark, d), "id", "text", LEAST_DOCS, VOCABULARY)
    w = Window.partitionBy("id").orderBy(F.desc(F.round("w", 9)), "term")
    return v.withColumn("rn", F.row_number().over(w)).where("rn <= 3").select("id", "term", F.round("w", 6).alias("w"))


#: Least cosine of texts and of vectors for each band of the redundancy scan, strongest first.
NEAR_DUP, SEMANTIC_DUP, THEMATIC_LOW = 0.72, 0.85, 0.70
_BAND = f"case when exact then 'exact' when tfidf >= {NEAR_DUP} then 'near-dup' when embedding >= {SEMANTIC_DUP} then 'semantic-dup' when embedding >= {THEMATIC_LOW} then 'thematic' end"
#: Bodies with white space collapsed, of equal ones the first; the vector of the k-th record is the k-th of the table.
_BODIES = b.C + r", nb as (select doc_id, trim(regexp_replace(body, '\s+', ' ', 'g')) as text, row_number() over (order by doc_id) - 1 as k from c where body is not null and trim(regexp_replace(body, '\s+', ' ', 'g')) <> ''), d as (select text, min(doc_id) as id from nb group by text)"
_SCAN = (
    "with "
    + _tfidf(_BODIES)
    + ", ev as (select doc_id, embedding::double[] as v from nb join embeddings on vec_id = k), em as (select x.doc_id as a, y.doc_id as b, list_cosine_similarity(x.v, y.v) as embedding from ev x join ev y on x.doc_id < y.doc_id)"
    + f", same as (select d.id as a, nb.doc_id as b, true as exact from nb join d on nb.text = d.text where nb.doc_id <> d.id), keys as (select a, b from same union select a, b from edges union select a, b from em where embedding >= {THEMATIC_LOW})"
    + f", pairs as (select a, b, {_BAND} as band, coalesce(tfidf, case when exact then 1.0 end) as tfidf from (select a, b, coalesce(exact, false) as exact, similarity as tfidf, case when embedding >= {THEMATIC_LOW} then embedding end as embedding from keys left join same using (a, b) left join edges using (a, b) left join em using (a, b)))"
)


def _scan(spark: SparkSession, d: str) -> DataFrame:
    bodies = b.cleaned(spark, d).select("doc_id", "body")
    return scan.pairs(bodies, lambda ids: _numbered(spark, d, ids), "doc_id", "body", THEMATIC_LOW, _BAND, _near)


def _numbered(spark: SparkSession, d: str, ids: DataFrame) -> DataFrame:
    """(doc_id, v): the k-th vector for the k-th record with a body (id)."""
    from ..operators.corpus import numbered

    k = numbered(ids.withColumnRenamed("id", "doc_id"), "doc_id").withColumnRenamed("n", "vec_id")
    return table(spark, d, "embeddings").select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").alias("v")).join(k, "vec_id").select("doc_id", "v")


@query("d16_redundancy", _SCAN + " select a, b, band, round(tfidf, 4) as tfidf from pairs where band is not null")
def d16(spark: SparkSession, d: str) -> DataFrame:
    """The redundancy scan: pairs of records by equal bodies, TF-IDF and vectors, in the strongest band of each; of equal bodies the first stands for all."""
    return _scan(spark, d).select("a", "b", "band", F.round("tfidf", 4).alias("tfidf"))


@query("f32_bands", _SCAN + " select band, count(*) as pairs from pairs where band is not null group by band")
def f32(spark: SparkSession, d: str) -> DataFrame:
    return _scan(spark, d).groupBy("band").agg(F.count("*").alias("pairs"))


@query("j7_clusters", _SCAN.replace("with ", "with recursive ", 1) + ", e as (select a, b from pairs where band is not null union select b, a from pairs where band is not null), r as (select a as node, a as seen from e union select r.node, e.b from r join e on r.seen = e.a), k as (select node, min(seen) as component from r group by node) select component, count(*) as size from k group by component")
def j7(spark: SparkSession, d: str) -> DataFrame:
    """The groups that the scan's pairs connect, with their sizes."""
    return graph.components(keep(_scan(spark, d)), "a", "b").groupBy("component").agg(F.count("*").alias("size"))
