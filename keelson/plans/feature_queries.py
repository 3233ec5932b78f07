"""Registered queries: feature engineering and preprocessing."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions.text import clean_name, value_map
from keelson.operators import features as P
from keelson.operators.splits import with_split
from keelson.plans.derived import CUSTOMERS, PRIORITIES, SEGMENTS, STATUSES, customers, split_sql
from keelson.plans.registry import query, rounded, table


def _dummies(column: str, values, clean: bool = False, first: int = 0) -> str:
    def name(v: str) -> str:
        return clean_name(f"{column}_{v}") if clean else f"{column}_{v}"

    return ", ".join(
        f"""(case when {column} = '{v}' then 1 else 0 end)::bigint "{name(v)}" """ for v in values[first:]
    )


@query("one_hot", f"""
select o_orderkey, {_dummies('o_orderstatus', STATUSES)}, {_dummies('o_orderpriority', PRIORITIES)} from orders""")
def one_hot(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return P.one_hot(orders, P.fit_vocab(orders, ["o_orderstatus", "o_orderpriority"]))


@query("label_map", """
select l_orderkey, l_linenumber, l_partkey, l_returnflag,
       case l_returnflag when 'A' then 1 when 'N' then 0 end::int as label from lineitem""")
def label_map(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag",
        value_map("l_returnflag", {"A": 1, "N": 0}).alias("label"),
    )


@query("clean_names", f"select o_orderkey, {_dummies('o_orderpriority', PRIORITIES, clean=True)} from orders")
def clean_names(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return P.rename_clean(P.one_hot(orders, P.fit_vocab(orders, ["o_orderpriority"])))


@query("drop_nulls", """
select o_orderkey, o_orderpriority, o_totalprice from orders
where o_orderpriority <> '4-NOT SPECIFIED' and o_totalprice >= 50000""")
def drop_nulls(spark, sf_dir) -> DataFrame:
    """Unspecified priorities and small prices count as unknown."""
    return P.drop_nulls(table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("o_orderpriority"),
        F.when(F.col("o_totalprice") >= 50000, F.col("o_totalprice")).alias("o_totalprice"),
    ))


CHURN_COLUMNS = ["c_mktsegment", "last_priority"]


@query("churn_features", f"""
with {CUSTOMERS}
select c_custkey, c_acctbal, n_orders, top_price, (case churn when 'Yes' then 1 else 0 end)::int churn,
       {_dummies('c_mktsegment', SEGMENTS, clean=True)}, {_dummies('last_priority', PRIORITIES, clean=True)}
from customers where churn is not null""")
def churn_features(spark, sf_dir) -> DataFrame:
    """The whole featuriser; customers without a label drop out, those without orders stay."""
    rows = customers(spark, sf_dir)
    return P.FeatureSpec(CHURN_COLUMNS, "churn").fit(rows).transform(rows)


@query("scoring_features", f"""
with {CUSTOMERS}
select c_custkey, c_acctbal, n_orders, top_price, (case churn when 'Yes' then 1 when 'No' then 0 end)::int churn,
       {_dummies('c_mktsegment', SEGMENTS, clean=True)}, {_dummies('last_priority', PRIORITIES, clean=True)}
from customers""")
def scoring_features(spark, sf_dir) -> DataFrame:
    """The same for scoring: unlabelled customers are kept."""
    rows = customers(spark, sf_dir)
    return P.FeatureSpec(CHURN_COLUMNS, "churn").fit(rows).transform(rows, training=False)


@query("select_supported", "select l_quantity, l_discount, l_tax from lineitem")
def select_supported(spark, sf_dir) -> DataFrame:
    return P.select_supported(table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount", "l_tax"])


@query("signature_select", "select l_quantity, l_linenumber::double l_linenumber, l_shipdate from lineitem")
def signature_select(spark, sf_dir) -> DataFrame:
    signature = T.StructType([
        T.StructField("l_quantity", T.DoubleType()), T.StructField("l_linenumber", T.DoubleType()),
        T.StructField("l_shipdate", T.TimestampNTZType()),
    ])
    return P.select_signature(table(spark, sf_dir, "lineitem"), signature)


@query("category_vocab", """
select 'o_orderstatus' as "column", o_orderstatus as value, count(*) n from orders group by 2
union all select 'o_orderpriority', o_orderpriority, count(*) from orders group by 2""")
def category_vocab(spark, sf_dir) -> DataFrame:
    return P.category_vocab(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"])


@query("mode_impute", """
with o as (select o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') p, o_orderstatus s from orders),
top as (select p from o where p is not null group by p order by count(*) desc, p desc limit 1)
select o_orderkey, coalesce(p, (select p from top)) o_orderpriority, s o_orderstatus from o""")
def mode_impute(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("o_orderpriority"), "o_orderstatus"
    )
    return P.mode_impute(orders, ["o_orderpriority", "o_orderstatus"])


@query("ohe_drop_first", f"""
select o_orderkey, {_dummies('o_orderstatus', STATUSES, first=1)},
       {_dummies('o_orderpriority', PRIORITIES, first=1)} from orders""")
def ohe_drop_first(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return P.one_hot(orders, P.fit_vocab(orders, ["o_orderstatus", "o_orderpriority"]), drop_first=True)


def _gappy_orders(spark, sf_dir) -> DataFrame:
    """Prices of open orders are unknown."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "O", F.col("o_totalprice")).alias("o_totalprice")
    )


GAPPY = "g as (select o_orderkey, case when o_orderstatus <> 'O' then o_totalprice end as price from orders)"


@query("mean_impute", f"""
with {GAPPY}
select o_orderkey, round(coalesce(price, (select avg(price) from g)), 4) o_totalprice from g""")
def mean_impute(spark, sf_dir) -> DataFrame:
    orders = _gappy_orders(spark, sf_dir)
    return rounded(P.NumericSpec(["o_totalprice"]).fit(orders).impute(orders), "o_totalprice", digits=4)


@query("impute_and_scale", f"""
with {GAPPY}, f as (select o_orderkey, coalesce(price, (select avg(price) from g)) as price from g)
select o_orderkey, round((price - (select avg(price) from g)) / (select stddev_pop(price) from f), 6) o_totalprice
from f""")
def impute_and_scale(spark, sf_dir) -> DataFrame:
    orders = _gappy_orders(spark, sf_dir)
    return rounded(P.NumericSpec(["o_totalprice"]).fit(orders).transform(orders), "o_totalprice")


@query("standardize", """
with s as (select avg(l_quantity) mq, stddev_pop(l_quantity) sq, avg(l_discount) md, stddev_pop(l_discount) sd
           from lineitem)
select l_orderkey, l_linenumber, round((l_quantity - mq) / sq, 6) l_quantity,
       round((l_discount - md) / sd, 6) l_discount
from lineitem, s""")
def standardize(spark, sf_dir) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    columns = ["l_quantity", "l_discount"]
    return rounded(P.NumericSpec(columns).fit(lines).transform(lines), *columns)


@query("assemble", """
select l_orderkey, l_linenumber, l_quantity f0, l_discount f1, l_linenumber::double f2 from lineitem""")
def assemble(spark, sf_dir) -> DataFrame:
    """The vector is taken apart again to show its cells."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    cells = vector_to_array("features")
    return P.assemble(lines, ["l_quantity", "l_discount", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber", *[F.get(cells, F.lit(i)).alias(f"f{i}") for i in range(3)]
    )


@query("fit_transform_split", f"""
with o as (select o_orderkey, o_totalprice, {split_sql('o_orderkey')} split from orders),
s as (select avg(o_totalprice) m, stddev_pop(o_totalprice) d from o where split = 'train')
select o_orderkey, split, round((o_totalprice - m) / d, 6) o_totalprice from o, s where split = 'val'""")
def fit_transform_split(spark, sf_dir) -> DataFrame:
    """Statistics from the train part, applied to the val part."""
    orders = with_split(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"])
    spec = P.NumericSpec(["o_totalprice"]).fit(orders.filter("split = 'train'"))
    return rounded(spec.transform(orders.filter("split = 'val'")), "o_totalprice")


@query("label_encode", """
select o_orderkey, o_orderstatus,
       (case o_orderstatus when 'F' then 0 when 'O' then 1 when 'P' then 2 end)::int code from orders""")
def label_encode(spark, sf_dir) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return P.label_encode(orders, "o_orderstatus", P.fit_labels(orders, "o_orderstatus"), "code")


@query("label_encode_many", """
select c_custkey, (dense_rank() over (order by c_name) - 1)::int code from customer""")
def label_encode_many(spark, sf_dir) -> DataFrame:
    """As many classes as rows: the class list is a table and has no limit."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return P.label_encode(customer, "c_name", P.fit_labels(customer, "c_name"), "code").drop("c_name")


@query("one_hot_wide", """
select c_custkey, (dense_rank() over (order by c_name) - 1)::int slot, 1.0::double total,
       (select count(distinct c_name) from customer)::int size from customer""")
def one_hot_wide(spark, sf_dir) -> DataFrame:
    """A sparse vector with a slot per customer name."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    encoded = P.wide_one_hot(customer, ["c_name"]).transform(customer)
    cells = F.unwrap_udt("encoded")
    return encoded.select(
        "c_custkey", F.get(cells["indices"], F.lit(0)).alias("slot"), F.aggregate(cells["values"], F.lit(0.0), lambda a, x: a + x).alias("total"),
        cells["size"].alias("size"))


@query("one_hot_wide_many", """
with k as (select o_orderkey, o_clerk_id, o_orderpriority p from (select *, (o_custkey % 977)::varchar o_clerk_id from orders)),
a as (select distinct o_clerk_id v from k where o_orderkey % 5 <> 0), b as (select distinct p v from k where o_orderkey % 5 <> 0),
sa as (select v, row_number() over (order by v) - 1 slot from a),
sb as (select v, row_number() over (order by v) - 1 + (select count(*) from a) slot from b)
select o_orderkey, [sa.slot, sb.slot]::varchar slots, ((select count(*) from a) + (select count(*) from b))::int size
from k join sa on sa.v = o_clerk_id join sb on sb.v = p""")
def one_hot_wide_many(spark, sf_dir) -> DataFrame:
    """Two columns, fitted on four fifths of the rows; rows with a value that those lack are left out here."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 977).cast("string").alias("clerk"), "o_orderpriority")
    encoded = P.wide_one_hot(orders.filter("o_orderkey % 5 <> 0"), ["clerk", "o_orderpriority"]).transform(orders)
    cells = F.unwrap_udt("encoded")
    slots = F.concat(F.lit("["), F.concat_ws(", ", F.transform(cells["indices"], lambda i: i.cast("string"))), F.lit("]"))
    return encoded.filter(F.size(cells["indices"]) == 2).select("o_orderkey", slots.alias("slots"), cells["size"].alias("size"))
