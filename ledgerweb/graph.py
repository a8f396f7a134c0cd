"""The property graph as typed DataFrames: one for each kind of node, one for each type of edge.

``BusinessGraph`` reads the graph from a star schema: suppliers are companies, customers their
web domains, brand and type of a part a technology, and two suppliers of one order are related.
Any other source fits by building the same frames.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Which order lines tell which relation: return flag and quantity of the citing line.
RELATIONS = {
    "HAS_COMPETITOR": ("A", 50),
    "HAS_SUPPLIER": ("R", 50),
    "HAS_PARTNER": ("N", 50),
    "HAS_CUSTOMER": ("A", 49),
}


def undirected(edges: DataFrame) -> DataFrame:
    """Every edge in both directions."""
    swapped = edges.select(*(F.col({"src": "dst", "dst": "src"}.get(c, c)).alias(c) for c in edges.columns))
    return edges.unionByName(swapped)


def blank_to_null(df: DataFrame) -> DataFrame:
    """Blank strings are absent values; others are not trimmed."""
    return df.select(*(F.when(F.trim(c) != "", F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in df.dtypes))


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    """Rows that break a uniqueness constraint: key and number of rows."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


class BusinessGraph:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def company(self) -> DataFrame:
        size = F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal") * 1e6)
        return (
            self.table("supplier").join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("s_suppkey").alias("cik"), F.col("s_name").alias("name"), F.concat(F.lit("T"), "s_suppkey").alias("ticker"),
                F.col("n_name").alias("industry"), F.col("r_name").alias("sector"), F.col("n_nationkey").cast("long").alias("sic"),
                size.alias("revenue"), (size * 2).alias("market_cap"), (F.col("s_suppkey") * 37 % 20000).alias("employees"),
            )
        )

    def edges(self, relation: str) -> DataFrame:
        """src, dst, confidence, embedding_similarity, mentions: one row for each pair."""
        return self.all_edges(relation).drop("rel_type")

    def all_edges(self, *relations: str) -> DataFrame:
        """The edges of several relations with their type, from one join of the order lines."""
        lines = self.table("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_discount", "l_returnflag")
        kind = reduce(lambda c, r: c.when((F.col("l_quantity") == RELATIONS[r][1]) & (F.col("l_returnflag") == RELATIONS[r][0]), r), relations or RELATIONS, F)
        most = max(RELATIONS[r][1] for r in relations or RELATIONS)
        a = lines.where(F.col("l_quantity").isin(*{float(RELATIONS[r][1]) for r in relations or RELATIONS})).withColumn("rel_type", kind).where("rel_type IS NOT NULL").alias("a")
        b = lines.where(F.col("l_quantity") < most).select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity").alias("b")
        on = "a.l_orderkey = b.l_orderkey AND a.l_linenumber < b.l_linenumber AND a.l_suppkey <> b.l_suppkey AND b.l_quantity < a.l_quantity"
        return (
            a.join(b, F.expr(on))
            .groupBy(F.col("a.l_suppkey").alias("src"), F.col("b.l_suppkey").alias("dst"), "rel_type")
            .agg(
                F.max(F.round(1 - F.col("a.l_discount") * 5, 6)).alias("confidence"),
                F.max(F.round(F.col("b.l_quantity") / 50, 6)).alias("embedding_similarity"),
                F.count("*").alias("mentions"),
            )
            .select("src", "dst", "confidence", "embedding_similarity", "mentions", "rel_type")
        )

    @cached_property
    def domain(self) -> DataFrame:
        return self.table("customer").select(F.col("c_custkey").alias("domain"), F.col("c_name").alias("title"), F.col("c_mktsegment").alias("keywords"))

    @cached_property
    def technology(self) -> DataFrame:
        return self.table("part").select(F.concat_ws("/", "p_brand", "p_type").alias("technology"), F.col("p_type").alias("category")).distinct()

    @cached_property
    def uses(self) -> DataFrame:
        """domain, technology: what a domain runs."""
        lines = self.table("lineitem").where("l_quantity >= 45").select("l_orderkey", "l_partkey")
        orders = self.table("orders").select("o_orderkey", F.col("o_custkey").alias("domain"))
        part = self.table("part").select("p_partkey", F.concat_ws("/", "p_brand", "p_type").alias("technology"))
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(part, F.col("l_partkey") == F.col("p_partkey")).select("domain", "technology").distinct()

    @cached_property
    def has_domain(self) -> DataFrame:
        """src (company), dst (domain)."""
        n = self.table("supplier").agg(F.count("*").alias("n"))  # one row
        dealt = self.domain.crossJoin(F.broadcast(n)).select((F.col("domain") % F.col("n")).alias("src"), F.col("domain").alias("dst"))
        return dealt.join(self.company.select(F.col("cik").alias("src")), "src", "left_semi")

    @cached_property
    def company_uses(self) -> DataFrame:
        """cik, technology: through any of the company's domains."""
        return self.has_domain.join(self.uses, F.col("dst") == F.col("domain")).select(F.col("src").alias("cik"), "technology").distinct()

    def company_vectors(self, shift: int = 0, least_chars: int = 200) -> DataFrame:
        """cik, embedding of texts of ``least_chars`` characters; ``shift`` counts companies, so different texts have different vectors."""
        n = self.table("supplier").agg(F.count("*").alias("n"))  # one row
        told = self.table("documents").where(F.length("text") >= least_chars).select(F.col("doc_id").alias("vec_id"))
        vec = self.table("embeddings").select("vec_id", "embedding").join(told, "vec_id", "left_semi").crossJoin(F.broadcast(n))
        vec = vec.select((F.col("vec_id") - F.lit(shift) * F.col("n")).alias("cik"), "embedding")
        return vec.join(self.company.select("cik"), "cik", "left_semi")
