"""Baseline queries over the star schema: what Spark itself brings, no part of the annotation operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from folioflow.operators.relational import count_between
from folioflow.registry import query, read


@query("select n_name, count(*) as n, round(sum(o_totalprice), 2) as total from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey group by n_name")
def bl_inner(spark: SparkSession, d: str) -> DataFrame:
    """Inner joins from a fact to dimensions."""
    o, c, n = (read(spark, d, t) for t in ("orders", "customer", "nation"))
    return o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).groupBy("n_name").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("select c_custkey, count(o_orderkey) as n from customer left join orders on o_custkey = c_custkey group by c_custkey")
def bl_left_outer(spark: SparkSession, d: str) -> DataFrame:
    c, o = read(spark, d, "customer"), read(spark, d, "orders")
    return c.join(o, c.c_custkey == o.o_custkey, "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("n"))


@query("select coalesce(a.k, b.k) as k, a.n as suppliers, b.n as customers from (select s_nationkey k, count(*) n from supplier where s_acctbal > 5000 group by 1) a full join (select c_nationkey k, count(*) n from customer where c_acctbal > 9000 group by 1) b on a.k = b.k")
def bl_full_outer(spark: SparkSession, d: str) -> DataFrame:
    a = read(spark, d, "supplier").where("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("suppliers"))
    b = read(spark, d, "customer").where("c_acctbal > 9000").groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("customers"))
    return a.join(b, "k", "outer")


@query("select c_custkey from customer where exists (select 1 from orders where o_custkey = c_custkey and o_totalprice > 300000)")
def bl_semi(spark: SparkSession, d: str) -> DataFrame:
    c, o = read(spark, d, "customer"), read(spark, d, "orders").where("o_totalprice > 300000")
    return c.join(o, c.c_custkey == o.o_custkey, "left_semi").select("c_custkey")


@query("select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey)")
def bl_anti(spark: SparkSession, d: str) -> DataFrame:
    c, o = read(spark, d, "customer"), read(spark, d, "orders")
    return c.join(o, c.c_custkey == o.o_custkey, "left_anti").select("c_custkey")


@query("select s_suppkey, count(*) as n from supplier join customer on s_nationkey = c_nationkey and c_acctbal between s_acctbal - 500 and s_acctbal + 500 group by s_suppkey")
def bl_theta_range(spark: SparkSession, d: str) -> DataFrame:
    ends = [(F.col("s_acctbal") - 500).alias("low"), (F.col("s_acctbal") + 500).alias("high")]
    s = read(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("k"), *ends)
    c = read(spark, d, "customer").select(F.col("c_nationkey").alias("k"), "c_acctbal")
    return s.join(count_between(c, s, "k", "c_acctbal", "low", "high", 10.0), ["k", "low", "high"]).groupBy("s_suppkey").agg(F.sum("n").alias("n"))


@query("select l_returnflag, l_linestatus, round(sum(l_quantity), 2) as qty, count(*) as n from lineitem where l_shipdate <= timestamp '1998-09-02' group by rollup (l_returnflag, l_linestatus)")
def bl_rollup(spark: SparkSession, d: str) -> DataFrame:
    l = read(spark, d, "lineitem").where("l_shipdate <= timestamp_ntz '1998-09-02'")
    return l.rollup("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("qty"), F.count(F.lit(1)).alias("n"))


@query("select o_orderstatus, o_orderpriority, count(*) as n from orders group by cube (o_orderstatus, o_orderpriority)")
def bl_cube(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").cube("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("select o_custkey, o_orderkey from orders qualify row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) <= 3")
def bl_topk_per_group(spark: SparkSession, d: str) -> DataFrame:
    r = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey"))
    return read(spark, d, "orders").withColumn("r", r).where("r <= 3").select("o_custkey", "o_orderkey")


@query("select s_nationkey as k from supplier union select c_nationkey from customer")
def bl_union(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "supplier").select(F.col("s_nationkey").alias("k")).union(read(spark, d, "customer").select("c_nationkey")).distinct()


@query("select s_nationkey as k from supplier intersect select c_nationkey from customer where c_acctbal > 9500")
def bl_intersect(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "supplier").select(F.col("s_nationkey").alias("k")).intersect(read(spark, d, "customer").where("c_acctbal > 9500").select("c_nationkey"))


@query("select n_nationkey as k from nation except select c_nationkey from customer where c_acctbal > 9500")
def bl_except(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "nation").select(F.col("n_nationkey").alias("k")).subtract(read(spark, d, "customer").where("c_acctbal > 9500").select("c_nationkey"))


@query("select p_partkey, rank() over w as rk, dense_rank() over w as dr, ntile(4) over (partition by p_brand order by p_retailprice, p_partkey) as quartile from part window w as (partition by p_brand order by p_size)")
def bl_rank_frames(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("p_brand").orderBy("p_size")
    quartile = F.ntile(4).over(Window.partitionBy("p_brand").orderBy("p_retailprice", "p_partkey"))
    return read(spark, d, "part").select("p_partkey", F.rank().over(w).cast("long").alias("rk"), F.dense_rank().over(w).cast("long").alias("dr"), quartile.cast("long").alias("quartile"))


@query("select l_orderkey, l_linenumber from lineitem l where l_quantity > (select 1.5 * avg(l_quantity) from lineitem x where x.l_partkey = l.l_partkey)")
def bl_correlated_subquery(spark: SparkSession, d: str) -> DataFrame:
    l = read(spark, d, "lineitem")
    mean = l.groupBy("l_partkey").agg((1.5 * F.avg("l_quantity")).alias("m"))
    return l.join(mean, "l_partkey").where("l_quantity > m").select("l_orderkey", "l_linenumber")


@query("select round(sum(l_extendedprice * l_discount), 2) as revenue from lineitem where l_shipdate >= timestamp '1995-01-01' and l_shipdate < timestamp '1996-01-01' and l_discount between 0.05 and 0.07 and l_quantity < 24")
def bl_filter_sum(spark: SparkSession, d: str) -> DataFrame:
    l = read(spark, d, "lineitem").where("l_shipdate >= timestamp_ntz '1995-01-01' and l_shipdate < timestamp_ntz '1996-01-01' and l_discount between 0.05 and 0.07 and l_quantity < 24")
    return l.agg(F.round(F.sum(F.col("l_extendedprice") * F.col("l_discount")), 2).alias("revenue"))
