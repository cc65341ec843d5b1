"""All queries over the given tables by name, each with its DuckDB counterpart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallybook.functions import dates, money, text
from tallybook.operators import constraints, dedupe, matching, resolve, upsert
from tallybook.operators.graph import settled
from tallybook.plans import stock

QUERIES = {}
ORACLE_SQL = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) under its name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` dealt out by a key: a given table is one row group, thus one task, and parsing is work for all cores."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism, key)


@query("""
WITH m AS (SELECT l_partkey AS item, l_shipdate::DATE AS day, (CASE WHEN l_returnflag = 'R' THEN 1 ELSE -1 END * l_quantity)::DECIMAL(18,2) AS q FROM lineitem),
d AS (SELECT item, day, sum(q) AS net FROM m GROUP BY ALL),
b AS (SELECT *, sum(net) OVER (PARTITION BY item ORDER BY day ROWS UNBOUNDED PRECEDING) AS bal FROM d)
SELECT p.p_partkey, p.p_name, min(day) AS first_negative, arg_min(bal, day)::DECIMAL(18,2) AS balance, count(*)::BIGINT AS days_negative
FROM b JOIN part p ON p.p_partkey = b.item WHERE bal < 0 GROUP BY p.p_partkey, p.p_name
""")
def negative_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V4: first evening below zero, that balance, and the number of such days."""
    lines = read(spark, sf_dir, "lineitem")
    signed = F.when(F.col("l_returnflag") == "R", F.col("l_quantity")).otherwise(-F.col("l_quantity")).cast("decimal(18,2)")
    moves = lines.select(F.col("l_partkey").alias("item"), F.to_date("l_shipdate").alias("day"), signed.alias("quantity"))
    found = stock.negative_stock(moves)
    part = read(spark, sf_dir, "part").select("p_partkey", "p_name")
    return found.join(part, F.col("item") == F.col("p_partkey")).select("p_partkey", "p_name", "first_negative", F.col("balance").cast("decimal(18,2)").alias("balance"), "days_negative")


# --- first-wins merging and outcomes --------------------------------------------------------------

_BOOKS = """
l AS (SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p, l_suppkey AS s, l_quantity::DECIMAL(12,2) AS q, l_extendedprice::DECIMAL(14,2) AS a, l_shipdate::DATE AS d FROM lineitem),
books AS (SELECT 'book' AS book, * FROM l UNION ALL SELECT 'book_revised' AS book, * FROM l WHERE p % 7 = 0),
ranked AS (SELECT *, concat_ws('|', p, s, q, a, d) AS fp,
  row_number() OVER w AS copy_no, first_value(concat_ws('|', p, s, q, a, d)) OVER w AS kept_fp, first_value(book) OVER w AS kept_book, first_value(d) OVER w AS kept_d
  FROM books WINDOW w AS (PARTITION BY k, n ORDER BY book, d, p, s, q, a)),
outcomes AS (SELECT *, CASE WHEN copy_no = 1 THEN 'loaded' WHEN fp = kept_fp THEN 'merged' ELSE 'rejected' END AS outcome FROM ranked)
"""


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"),
        F.col("l_quantity").cast("decimal(12,2)").alias("q"), F.col("l_extendedprice").cast("decimal(14,2)").alias("a"), F.to_date("l_shipdate").alias("d"),
    )
    books = lines.select(F.explode(F.when(F.col("p") % 7 == 0, F.array(F.lit("book"), F.lit("book_revised"))).otherwise(F.array(F.lit("book")))).alias("book"), "*")
    values = ["p", "s", "q", "a", "d"]
    ranked = dedupe.rank_copies(books, ["k", "n"], ["book", "d", "p", "s", "q", "a"], None, ["book", *values])  # prints are made of the kept values, not shuffled
    prints = {"print": dedupe.fingerprint(*[F.col(c) for c in values]), "kept_print": dedupe.fingerprint(*[F.col(f"kept_{c}") for c in values])}
    return ranked.withColumns(prints).withColumn("outcome", dedupe.outcome())


@query(f"WITH {_BOOKS} SELECT book, k AS order_key, n AS line_number, copy_no::INT AS copy_no, outcome, fp AS print FROM outcomes")
def dedupe_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first copy loads, equal ones merge into it, others are conflicts."""
    return _outcomes(spark, sf_dir).select("book", F.col("k").alias("order_key"), F.col("n").alias("line_number"), "copy_no", "outcome", "print")


@query(f"""WITH {_BOOKS} SELECT year(d)::INT AS year, count(*)::BIGINT AS n_rows, count(DISTINCT book)::BIGINT AS books,
 count(*) FILTER (WHERE outcome = 'loaded')::BIGINT AS loaded, count(*) FILTER (WHERE outcome = 'merged')::BIGINT AS merged, count(*) FILTER (WHERE outcome = 'rejected')::BIGINT AS rejected
 FROM outcomes GROUP BY 1""")
def row_outcomes_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How rows of each year ended."""
    o = F.col("outcome")
    return _outcomes(spark, sf_dir).groupBy(F.year("d").alias("year")).agg(
        F.count("*").alias("n_rows"), F.countDistinct("book").alias("books"), F.count_if(o == "loaded").alias("loaded"), F.count_if(o == "merged").alias("merged"), F.count_if(o == "rejected").alias("rejected")
    )


@query(f"""WITH {_BOOKS}, m AS (SELECT *, CASE WHEN book = kept_book AND d = kept_d THEN 'same sheet' WHEN book = kept_book THEN 'same workbook' ELSE 'another workbook' END AS location FROM outcomes WHERE outcome = 'merged')
 SELECT location, count(*)::BIGINT AS n_rows, min(k) AS example_key FROM m GROUP BY 1""")
def merged_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V9: where merged rows stood against the row that was kept."""
    where = F.when((F.col("book") == F.col("kept_book")) & (F.col("d") == F.col("kept_d")), "same sheet").when(F.col("book") == F.col("kept_book"), "same workbook").otherwise("another workbook")
    return _outcomes(spark, sf_dir).where("outcome = 'merged'").groupBy(where.alias("location")).agg(F.count("*").alias("n_rows"), F.min("k").alias("example_key"))


@query(f"""WITH {_BOOKS}, r AS (SELECT *, year(d)::VARCHAR AS reason FROM outcomes WHERE outcome = 'rejected'),
 x AS (SELECT reason, k, n, copy_no, count(*) OVER (PARTITION BY reason) AS total, row_number() OVER (PARTITION BY reason ORDER BY k, n, copy_no) AS i FROM r)
 SELECT reason, k AS order_key, n AS line_number, copy_no::INT AS copy_no, total::BIGINT AS total, i::INT AS i FROM x WHERE i <= 3 OR i = total""")
def reject_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three examples of each reason and its last, with the reason's count (count and last are grouped, not windowed)."""
    r = settled(_outcomes(spark, sf_dir).where("outcome = 'rejected'").select(F.year("d").cast("string").alias("reason"), F.col("k").alias("order_key"), F.col("n").alias("line_number"), "copy_no"))
    first = r.withColumn("i", F.row_number().over(Window.partitionBy("reason").orderBy("order_key", "line_number", "copy_no"))).where("i <= 3")
    every = r.groupBy("reason").agg(F.count("*").alias("total"), F.max(F.struct("order_key", "line_number", "copy_no")).alias("last"))
    last = every.where("total > 3").select("reason", "last.*", "total", F.col("total").cast("int").alias("i"))
    return first.join(every, "reason").select("reason", "order_key", "line_number", "copy_no", "total", "i").unionByName(last)


# --- resolution -----------------------------------------------------------------------------------


@query(r"""WITH c AS (SELECT c_custkey, nullif(trim(regexp_replace(lower(c_name), '[^a-z0-9]+', ' ', 'g')), '') AS ckey FROM customer),
 o AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_custkey END AS code, CASE WHEN o_orderkey % 5 = 0 THEN 'unknown' ELSE ckey END AS dkey FROM orders LEFT JOIN c ON c_custkey = o_custkey)
 SELECT o_orderkey, coalesce(a.c_custkey, b.c_custkey) AS customer, CASE WHEN coalesce(a.c_custkey, b.c_custkey) IS NULL THEN 'UNKNOWN_PRODUCT' END AS reason
 FROM o LEFT JOIN c a ON o.code = a.c_custkey LEFT JOIN c b ON o.code IS NULL AND o.dkey = b.ckey""")
def resolve_code_or_description(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By code, or by description key where the code is missing; unknown ones are rejected."""
    items = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer"), F.col("c_custkey").alias("code_"), text.description_key(F.col("c_name")).alias("key_"))
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(items.select("code_", "key_"), F.col("o_custkey") == F.col("code_"), "left")
    rows = orders.select("o_orderkey", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey")).alias("code"), F.when(F.col("o_orderkey") % 5 == 0, "unknown").otherwise(F.col("key_")).alias("dkey"))
    out = resolve.by_code_or_key(rows, items, "code", "dkey", "customer", "code_", "key_")
    return out.select("o_orderkey", "customer", F.when(F.col("customer").isNull(), "UNKNOWN_PRODUCT").alias("reason"))


@query("""SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0)""")
def unknown_reference_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose reference isn't there."""
    known = read(spark, sf_dir, "customer").where("c_acctbal > 0").select("c_custkey")
    return read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(known, F.col("o_custkey") == F.col("c_custkey"), "left_anti")


@query("""WITH o AS (SELECT o_orderkey, o_totalprice::DECIMAL(14,2) AS amount, date_trunc('month', o_orderdate)::DATE AS month, CASE WHEN o_custkey % 2 = 0 THEN 'USD' ELSE 'RWF' END AS currency FROM orders)
 SELECT o_orderkey, currency, month, (CASE WHEN currency = 'RWF' THEN 1 ELSE 1000 + 5 * ((year(month) - 2015) * 12 + month(month) - 1) END)::DECIMAL(12,4) AS rate_to_rwf,
 round(amount * (CASE WHEN currency = 'RWF' THEN 1 ELSE 1000 + 5 * ((year(month) - 2015) * 12 + month(month) - 1) END)::DECIMAL(12,4), 2)::DECIMAL(18,2) AS amount_rwf FROM o""")
def fx_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts at their month's rate, half up. Rates are one row per month and currency, so the planner broadcasts them by size."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(14,2)").alias("amount"), F.trunc("o_orderdate", "MM").alias("month"), F.when(F.col("o_custkey") % 2 == 0, "USD").otherwise("RWF").alias("currency"))
    span = orders.agg(F.min("month").alias("a"), F.max("month").alias("b"))
    rates = resolve.fx_rates(span, F.col("a"), F.col("b"))
    return orders.join(rates, ["currency", "month"]).select("o_orderkey", "currency", "month", "rate_to_rwf", resolve.convert(F.col("amount"), F.col("rate_to_rwf")).alias("amount_rwf"))


@query("""WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_extendedprice, l_shipdate,
 first_value(l_suppkey % 3) OVER w AS s, first_value(l_returnflag) OVER w AS f FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice))
 SELECT l_orderkey, l_linenumber, l_partkey, (l_suppkey % 3 = s AND l_returnflag = f) AS header_ok FROM l""")
def header_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header comes from the first line; lines that disagree are found by one window."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_extendedprice", "l_shipdate", (F.col("l_suppkey") % 3).alias("group"))
    out = resolve.header_mismatches(lines, "l_orderkey", ["l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"], ["group", "l_returnflag"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "header_ok")


@query("""WITH s AS (SELECT o_custkey, o_orderdate::DATE AS d, o_orderpriority AS p, o_orderstatus AS st, o_orderkey FROM orders)
 SELECT o_custkey AS employee, (SELECT p FROM (SELECT p, count(*) AS n FROM s x WHERE x.o_custkey = s.o_custkey GROUP BY p ORDER BY n DESC, p LIMIT 1)) AS usual,
 arg_max(st, (d, o_orderkey)) AS latest, min(d) AS first_day, max(d) AS last_day, count(*)::BIGINT AS uses FROM s GROUP BY o_custkey""")
def entity_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Modal value, latest value and span in one grouping (ties of the mode: the smallest)."""
    orders = read(spark, sf_dir, "orders").withColumn("d", F.to_date("o_orderdate"))
    uses = orders.groupBy("o_custkey", "o_orderpriority").agg(
        F.count("*").alias("n"), F.min("d").alias("a"), F.max("d").alias("b"), F.max(F.struct("d", "o_orderkey", "o_orderstatus")).alias("last")
    )  # one row per value and customer, so the second grouping is small
    return uses.groupBy(F.col("o_custkey").alias("employee")).agg(
        F.min(F.struct((-F.col("n")).alias("n"), "o_orderpriority"))["o_orderpriority"].alias("usual"), F.max("last")["o_orderstatus"].alias("latest"),
        F.min("a").alias("first_day"), F.max("b").alias("last_day"), F.sum("n").alias("uses"),
    )


@query(r"""WITH c AS (SELECT c_custkey, c_mktsegment || ' ' || (c_custkey % 600)::VARCHAR AS k FROM customer),
 g AS (SELECT k, count(DISTINCT c_custkey) AS n, min(c_custkey) AS one FROM c GROUP BY k),
 r AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_custkey END AS code, CASE WHEN o_orderkey % 11 = 0 THEN 'nobody' ELSE c.k END AS k FROM orders LEFT JOIN c ON c.c_custkey = o_custkey)
 SELECT o_orderkey, coalesce(code, CASE WHEN n = 1 THEN one END) AS resolved_code,
 CASE WHEN code IS NOT NULL OR n = 1 THEN NULL WHEN n IS NULL THEN 'UNKNOWN_EMPLOYEE' ELSE 'AMBIGUOUS_EMPLOYEE' END AS reason FROM r LEFT JOIN g ON code IS NULL AND r.k = g.k""")
def name_key_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a code, the only person of that name; none or several are reasons."""
    people = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("code"), F.concat_ws(" ", "c_mktsegment", (F.col("c_custkey") % 600).cast("string")).alias("k"))
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(people.withColumnRenamed("code", "c"), F.col("o_custkey") == F.col("c"), "left")
    rows = orders.select("o_orderkey", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_custkey")).alias("code"), F.when(F.col("o_orderkey") % 11 == 0, "nobody").otherwise(F.col("k")).alias("k"))
    return resolve.by_unique_name(rows, people, "code", "k").select("o_orderkey", "resolved_code", "reason")


# --- upsert ---------------------------------------------------------------------------------------

_UPSERT = """old AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice::DECIMAL(14,2) AS price FROM orders WHERE o_orderkey % 4 <> 0),
new AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 = 3 THEN NULL ELSE o_orderstatus END AS o_orderstatus, (o_totalprice + CASE WHEN o_orderkey % 9 = 1 THEN 0.01 ELSE 0 END)::DECIMAL(14,2) AS price FROM orders WHERE o_orderkey % 5 <> 0),
j AS (SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey, CASE WHEN n.o_orderkey IS NULL THEN o.o_custkey ELSE n.o_custkey END AS o_custkey, CASE WHEN n.o_orderkey IS NULL THEN o.o_orderstatus ELSE n.o_orderstatus END AS o_orderstatus,
 CASE WHEN n.o_orderkey IS NULL THEN o.price ELSE n.price END AS price,
 CASE WHEN o.o_orderkey IS NULL THEN 'insert' WHEN n.o_orderkey IS NULL THEN 'keep' WHEN (o.o_custkey, o.o_orderstatus, o.price) IS NOT DISTINCT FROM (n.o_custkey, n.o_orderstatus, n.price) THEN 'unchanged' ELSE 'update' END AS action
 FROM old o FULL JOIN new n ON o.o_orderkey = n.o_orderkey)"""


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    old = orders.where(k % 4 != 0).select("o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(14,2)").alias("price"))
    price = (F.col("o_totalprice") + F.when(k % 9 == 1, 0.01).otherwise(0.0)).cast("decimal(14,2)")
    new = orders.where(k % 5 != 0).select("o_orderkey", "o_custkey", F.when(k % 10 != 3, F.col("o_orderstatus")).alias("o_orderstatus"), price.alias("price"))
    return upsert.diff(old, new, ["o_orderkey"], ["o_custkey", "o_orderstatus", "price"])


@query(f"WITH {_UPSERT} SELECT * FROM j")
def upsert_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full-outer diff by key; only real changes count as updates, nothing is deleted."""
    return _changes(spark, sf_dir)


@query(f"WITH {_UPSERT} SELECT 'orders' AS table_name, count(*) FILTER (WHERE action = 'insert')::BIGINT AS inserted, count(*) FILTER (WHERE action = 'update')::BIGINT AS updated FROM j")
def upsert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of one load."""
    return upsert.change_counts("orders", _changes(spark, sf_dir))


@query("""WITH known AS (SELECT o_orderkey AS k, o_orderkey + 1000 AS id FROM orders WHERE o_orderkey % 3 = 0),
 top AS (SELECT max(id) AS t FROM known), fresh AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 3 <> 0 GROUP BY 1)
 SELECT count(*)::BIGINT AS n, count(DISTINCT id)::BIGINT AS ids, min(id)::BIGINT AS lowest, max(id)::BIGINT AS highest FROM
 (SELECT id FROM known UNION ALL SELECT t + row_number() OVER (ORDER BY k) FROM fresh, top)""")
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U9 keys: known ids stay, new ones go on without gaps."""
    orders = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    known = orders.where("k % 3 = 0").select("k", (F.col("k") + 1000).alias("id"))
    out = upsert.assign_ids(orders, known, ["k"], "id")
    return out.agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids"), F.min("id").alias("lowest"), F.max("id").alias("highest"))


# --- reconciliation reports -----------------------------------------------------------------------


@query("""WITH o AS (SELECT l_orderkey AS po, l_partkey AS item, sum(l_quantity::DECIMAL(12,2)) AS ordered FROM lineitem WHERE l_linestatus = 'O' GROUP BY ALL),
 r AS (SELECT l_orderkey AS po, l_partkey AS item, sum((l_quantity - CASE WHEN l_linenumber % 2 = 0 THEN 1 ELSE 0 END)::DECIMAL(12,2)) AS received FROM lineitem WHERE l_returnflag <> 'R' GROUP BY ALL)
 SELECT CASE WHEN ordered IS NULL THEN 'received without order' WHEN received IS NULL THEN 'not received' WHEN received < ordered THEN 'short' WHEN received > ordered THEN 'over' ELSE 'exact' END AS status, count(*)::BIGINT AS lines
 FROM o FULL JOIN r USING (po, item) GROUP BY 1""")
def receipts_vs_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3, J18, G10, G13."""
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("po"), F.col("l_partkey").alias("item"), "l_quantity", "l_linenumber", "l_linestatus", "l_returnflag")
    ordered = lines.where("l_linestatus = 'O'").groupBy("po", "item").agg(F.sum(F.col("l_quantity").cast("decimal(12,2)")).alias("ordered"))
    got = (F.col("l_quantity") - F.when(F.col("l_linenumber") % 2 == 0, 1).otherwise(0)).cast("decimal(12,2)")
    received = lines.where("l_returnflag <> 'R'").groupBy("po", "item").agg(F.sum(got).alias("received"))
    return stock.receipts_vs_orders(ordered, received, ["po", "item"])


@query("""WITH a AS (SELECT l_partkey AS item, date_trunc('month', l_shipdate)::DATE AS month, sum(l_quantity::DECIMAL(12,2)) AS sold FROM lineitem WHERE l_returnflag <> 'R' GROUP BY ALL),
 b AS (SELECT l_partkey AS item, date_trunc('month', l_shipdate)::DATE AS month, sum(l_quantity::DECIMAL(12,2)) AS issued FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL)
 SELECT CASE WHEN sold IS NULL THEN 'only issued' WHEN issued IS NULL THEN 'only sold' WHEN sold = issued THEN 'equal' ELSE 'different' END AS status, count(*)::BIGINT AS n FROM a FULL JOIN b USING (item, month) GROUP BY 1""")
def sales_vs_stock_card(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V5, J19."""
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("item"), F.trunc("l_shipdate", "MM").alias("month"), F.col("l_quantity").cast("decimal(12,2)").alias("q"), "l_returnflag", "l_linestatus")
    sold = lines.where("l_returnflag <> 'R'").groupBy("item", "month").agg(F.sum("q").alias("sold"))
    issued = lines.where("l_linestatus = 'F'").groupBy("item", "month").agg(F.sum("q").alias("issued"))
    return stock.two_books(sold, issued, ["item", "month"], "sold", "issued")


@query("""WITH o AS (SELECT year(o_orderdate)::INT AS year, sum(o_totalprice::DECIMAL(14,2))::DECIMAL(24,2) AS purchases, (sum(o_totalprice::DECIMAL(14,2)) FILTER (WHERE o_orderstatus = 'F'))::DECIMAL(24,2) AS export_part FROM orders GROUP BY 1),
 l AS (SELECT year(l_shipdate)::INT AS year, sum(l_extendedprice::DECIMAL(14,2))::DECIMAL(24,2) AS sales, round(sum(l_quantity::DECIMAL(14,4)) / count(*), 1)::DECIMAL(18,1) AS headcount FROM lineitem GROUP BY 1),
 e AS (SELECT year(ts)::INT AS year, count(*)::BIGINT AS events FROM events GROUP BY 1)
 SELECT year, purchases, export_part, sales, headcount, events FROM o FULL JOIN l USING (year) FULL JOIN e USING (year)""")
def yearly_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three books side by side by year."""
    price = F.col("o_totalprice").cast("decimal(14,2)")
    o = read(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.sum(price).cast("decimal(24,2)").alias("purchases"), F.sum(F.when(F.col("o_orderstatus") == "F", price)).cast("decimal(24,2)").alias("export_part"))
    q = F.col("l_quantity").cast("decimal(14,4)")
    lines = read(spark, sf_dir, "lineitem").groupBy(F.year("l_shipdate").alias("year")).agg(F.sum(F.col("l_extendedprice").cast("decimal(14,2)")).cast("decimal(24,2)").alias("sales"), F.round(F.avg(q), 1).cast("decimal(18,1)").alias("headcount"))
    e = read(spark, sf_dir, "events").groupBy(F.year("ts").alias("year")).agg(F.count("*").alias("events"))
    return o.join(lines, "year", "full").join(e, "year", "full").select("year", "purchases", "export_part", "sales", "headcount", "events")


@query("""WITH g AS (SELECT o_clerk, p, n FROM (SELECT o_custkey % 50 AS o_clerk, o_orderpriority AS p, count(*) AS n FROM orders GROUP BY ALL))
 SELECT o_clerk AS supplier, string_agg(p, ' | ' ORDER BY n DESC, p) AS spellings, count(*)::BIGINT AS n_spellings, sum(n)::BIGINT AS n_rows FROM g GROUP BY 1 ORDER BY n_rows DESC, supplier LIMIT 8""")
def top_spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight largest with their spellings, most frequent first."""
    g = read(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 50).alias("supplier"), F.col("o_orderpriority").alias("p")).agg(F.count("*").alias("n"))
    names = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "p"))), lambda x: x["p"]), " | ")
    return g.groupBy("supplier").agg(names.alias("spellings"), F.count("*").alias("n_spellings"), F.sum("n").alias("n_rows")).orderBy(F.desc("n_rows"), "supplier").limit(8)


@query("""SELECT l_shipmode AS source, currency, count(*)::BIGINT AS n FROM (SELECT l_returnflag AS l_shipmode, l_linestatus AS currency FROM lineitem UNION ALL SELECT o_orderpriority, o_orderstatus FROM orders) GROUP BY 1, 2""")
def counts_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table from several books, counted by source and currency."""
    a = read(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("source"), F.col("l_linestatus").alias("currency"))
    b = read(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("source"), F.col("o_orderstatus").alias("currency"))
    return a.unionByName(b).groupBy("source", "currency").agg(F.count("*").alias("n"))


@query("""WITH r AS (SELECT DISTINCT o_orderpriority AS code FROM orders UNION SELECT 'UNUSED'), x AS (SELECT code, count(o_orderkey)::BIGINT AS n FROM r LEFT JOIN orders ON o_orderpriority = code AND o_orderstatus = 'F' GROUP BY code HAVING count(o_orderkey) > 0) SELECT * FROM x""")
def reasons_with_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasons that were used, with counts."""
    orders = read(spark, sf_dir, "orders")
    reasons = orders.select(F.col("o_orderpriority").alias("code")).distinct().unionByName(spark.range(1).select(F.lit("UNUSED").alias("code")))
    used = orders.where("o_orderstatus = 'F'").groupBy(F.col("o_orderpriority").alias("c")).agg(F.count("*").alias("n"))
    return reasons.join(used, F.col("code") == F.col("c"), "left").where("n > 0").select("code", "n")


# --- parsers, by writing values messily and reading them again -------------------------------------

_STYLES = 8


@query("""SELECT o_orderkey, (o_totalprice::DECIMAL(14,2))::DECIMAL(38,10) AS amount, CASE o_orderkey % 8 WHEN 2 THEN 'RWF' WHEN 3 THEN 'USD' WHEN 6 THEN 'RWF' END AS currency FROM orders""")
def parse_money_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, A2, A4: totals in eight styles of spelling."""
    x = F.col("o_totalprice").cast("decimal(14,2)")
    grouped = F.format_number(x, 2)
    dotted = F.translate(grouped, ",.", ".,")
    styles = [x.cast("string"), grouped, F.concat(F.lit("RWF "), grouped), F.concat(F.lit("$"), grouped), dotted, F.concat(grouped, F.lit("/=")), F.concat(F.regexp_replace(grouped, ",", " "), F.lit(" Frw")), F.concat(F.lit(" "), F.regexp_replace(grouped, ",", " "))]
    cell = F.element_at(F.array(*styles), (F.col("o_orderkey") % _STYLES + 1).cast("int"))
    rows = read(spark, sf_dir, "orders").select("o_orderkey", money.money(cell).alias("m"))
    return rows.select("o_orderkey", "m.amount", "m.currency")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, (CASE WHEN l_linenumber % 3 = 2 THEN -1 ELSE 1 END * l_quantity)::DECIMAL(12,2)::DECIMAL(38,10) AS quantity FROM lineitem""")
def parse_quantity_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: quantities with units and signs."""
    q = F.col("l_quantity").cast("decimal(12,2)").cast("string")
    cell = F.when(F.col("l_linenumber") % 3 == 0, F.concat(q, F.lit(" pcs"))).when(F.col("l_linenumber") % 3 == 1, F.concat(q, F.lit(" m."))).otherwise(F.concat(F.lit("("), q, F.lit(")")))
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", money.quantity(cell)["quantity"].alias("quantity"))


@query("""WITH o AS (SELECT o_orderkey, o_orderdate::DATE AS d, o_custkey % 6 AS style FROM orders)
 SELECT o_orderkey, d AS date, CASE style WHEN 0 THEN 'iso' WHEN 1 THEN 'excel_serial' WHEN 2 THEN 'text_month' WHEN 5 THEN 'text_month'
  ELSE CASE WHEN day(d) = month(d) THEN 'same_day_month' WHEN day(d) > 12 AND style = 3 THEN 'day_first' WHEN day(d) > 12 THEN 'month_first' ELSE 'sheet_convention' END END AS method FROM o""")
def resolve_dates_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates in six styles, one sheet per style; ambiguous ones follow their sheet."""
    d, style = F.to_date("o_orderdate"), F.col("o_custkey") % 6
    cells = [F.date_format(d, "yyyy-MM-dd"), F.datediff(d, F.lit("1899-12-30").cast("date")).cast("string"), F.date_format(d, "d-MMM-yyyy"), F.date_format(d, "dd/MM/yyyy"), F.date_format(d, "M/d/yyyy"), F.date_format(d, "MMMM d, yyyy")]
    cell = F.element_at(F.array(*cells), (style + 1).cast("int"))
    year = F.year(d)
    low, high = dates.valid_range(year)
    rows = read(spark, sf_dir, "orders").select("o_orderkey", dates.tokenize(cell).alias("t"), style.cast("string").alias("book"), style.cast("string").alias("sheet"), F.col("o_orderkey").alias("row_num"), low.alias("range_start"), high.alias("range_end"))
    return dates.resolve_dates(rows, "t").select("o_orderkey", "date", F.col("date_method").alias("method"))


@query("""SELECT o_orderkey, 'PO-' || year(o_orderdate)::VARCHAR || '-' || lpad((o_orderkey % 100000)::VARCHAR, 5, '0') AS po_number, 'E' || lpad((o_custkey % 10000)::VARCHAR, CASE WHEN o_custkey % 10000 > 999 THEN 4 ELSE 3 END, '0') AS employee_code,
 'FAB-COT-' || lpad((o_custkey % 1000)::VARCHAR, 3, '0') AS sku FROM orders""")
def normalize_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document numbers, employee numbers and product codes as people type them."""
    n, y = (F.col("o_orderkey") % 100000).cast("string"), F.year("o_orderdate").cast("string")
    po = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("po "), y, F.lit("/"), n)).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit(" PO"), y, F.lit("-"), n)).otherwise(F.concat(F.lit("Po-"), y, F.lit(" - "), n))
    e = (F.col("o_custkey") % 10000).cast("string")
    emp = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("emp-"), e)).otherwise(e)
    item = F.concat(F.lit("fab "), F.lit("cot."), (F.col("o_custkey") % 1000).cast("string"))
    return read(spark, sf_dir, "orders").select("o_orderkey", text.document(po, "purchases").alias("po_number"), text.employee(emp).alias("employee_code"), text.sku(item).alias("sku"))


@query("""WITH v AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity::DECIMAL(12,2) AS q, l_extendedprice::DECIMAL(14,2) AS a, p_retailprice::DECIMAL(14,2) AS p FROM lineitem JOIN part ON p_partkey = l_partkey)
 SELECT l_orderkey, l_linenumber, l_partkey, abs(a - q * p) <= greatest(0.01, 0.001 * a) AS ok FROM v""")
def line_tolerance_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amount against quantity times price."""
    part = read(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").cast("decimal(14,2)").alias("p"))
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").cast("decimal(12,2)").alias("q"), F.col("l_extendedprice").cast("decimal(14,2)").alias("a"))
    both = lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
    return both.select("l_orderkey", "l_linenumber", "l_partkey", money.within_tolerance(F.col("a"), F.col("q"), F.col("p")).alias("ok"))


@query("""SELECT 'quantity positive' AS rule, count(*) FILTER (WHERE NOT l_quantity > 0)::BIGINT AS violations FROM lineitem
 UNION ALL SELECT 'discount below 5 %', count(*) FILTER (WHERE NOT l_discount < 0.05)::BIGINT FROM lineitem
 UNION ALL SELECT 'flag known', count(*) FILTER (WHERE NOT l_returnflag IN ('A', 'R'))::BIGINT FROM lineitem
 UNION ALL SELECT 'line key', count(*)::BIGINT FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
 UNION ALL SELECT 'line to order', count(*)::BIGINT FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)
 UNION ALL SELECT 'order to rich customer', count(*)::BIGINT FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0)""")
def constraint_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value rules in one scan, keys by a grouping, references by anti joins."""
    lines, orders, customer = (read(spark, sf_dir, t) for t in ("lineitem", "orders", "customer"))
    out = constraints.check(lines, {"quantity positive": F.col("l_quantity") > 0, "discount below 5 %": F.col("l_discount") < 0.05, "flag known": F.col("l_returnflag").isin("A", "R")})
    out = out.unionByName(constraints.unique(lines, "line key", ["l_orderkey", "l_linenumber"]))
    out = out.unionByName(constraints.foreign_key(lines, "line to order", ["l_orderkey"], orders, ["o_orderkey"]))
    return out.unionByName(constraints.foreign_key(orders, "order to rich customer", ["o_custkey"], customer.where("c_acctbal > 0"), ["c_custkey"]))


@query("""SELECT event_id, 'k: ' || json_extract_string(props, '$.k') AS preview FROM events""")
def json_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a preview of raw cells, blanks dropped, at most 140 characters."""
    cells = F.from_json("props", "map<string,string>")
    shown = F.filter(F.map_entries(cells), lambda e: e["value"].isNotNull() & (e["value"] != ""))
    preview = F.array_join(F.transform(shown, lambda e: F.concat(e["key"], F.lit(": "), e["value"])), "; ")
    return read(spark, sf_dir, "events").select("event_id", F.when(F.length(preview) > 140, F.concat(F.substring(preview, 1, 137), F.lit("..."))).otherwise(preview).alias("preview"))


@query("""WITH r AS (SELECT c_custkey % 40 AS truth, c_nationkey AS predicted FROM customer),
 p AS (SELECT sum(n * (n - 1) // 2) AS p FROM (SELECT count(*) AS n FROM r GROUP BY predicted)), t AS (SELECT sum(n * (n - 1) // 2) AS p FROM (SELECT count(*) AS n FROM r GROUP BY truth)), b AS (SELECT sum(n * (n - 1) // 2) AS p FROM (SELECT count(*) AS n FROM r GROUP BY predicted, truth))
 SELECT b.p::BIGINT AS correct, p.p::BIGINT AS predicted, t.p::BIGINT AS true_pairs, b.p::DOUBLE / p.p::DOUBLE AS "precision", b.p::DOUBLE / t.p::DOUBLE AS recall,
 2 * (b.p::DOUBLE / p.p::DOUBLE) * (b.p::DOUBLE / t.p::DOUBLE) / (b.p::DOUBLE / p.p::DOUBLE + b.p::DOUBLE / t.p::DOUBLE) AS f1 FROM p, t, b""")
def pair_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a clustering against the truth."""
    rows = read(spark, sf_dir, "customer").select((F.col("c_custkey") % 40).alias("truth"), F.col("c_nationkey").alias("guess"))
    return matching.pair_scores(rows, "guess", "truth")


@query("""SELECT o_orderkey, date_trunc('month', o_orderdate)::DATE AS period FROM orders""")
def parse_period_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months as payroll sheets are named."""
    d = F.to_date("o_orderdate")
    names = [F.date_format(d, "MMM yyyy"), F.upper(F.date_format(d, "MMM-yy")), F.date_format(d, "yyyy-MM"), F.date_format(d, "MM.yyyy"), F.date_format(d, "MMMM"), F.concat(F.date_format(d, "MMMM yyyy"), F.lit(" (2)"))]
    name = F.element_at(F.array(*names), (F.col("o_orderkey") % len(names) + 1).cast("int"))
    # two-digit years below 70 mean 20xx, so only orders before 1970 would be read wrongly
    return read(spark, sf_dir, "orders").select("o_orderkey", dates.parse_period(name, F.year(d)).alias("period"))


@query("""WITH r AS (SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'RWF' END AS col, CASE o_custkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'RWF' END AS emb, CASE WHEN o_orderkey % 7 < 5 THEN 'RWF' END AS head, o_orderkey % 4 = 2 AS odd FROM orders)
 SELECT k AS o_orderkey, CASE WHEN reason IS NULL THEN coalesce(col, emb, head) END AS currency,
 CASE WHEN reason IS NULL THEN CASE WHEN col IS NOT NULL THEN 'column' WHEN emb IS NOT NULL THEN 'embedded' ELSE 'header' END END AS source, reason
 FROM (SELECT *, CASE WHEN odd THEN 'UNKNOWN_CURRENCY' WHEN col <> emb THEN 'CURRENCY_CONFLICT' WHEN coalesce(col, emb, head) IS NULL THEN 'UNKNOWN_CURRENCY' END AS reason FROM r)""")
def currency_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4, A5: the column before the marker in the text before the header; unknown words and conflicts are reasons."""
    k = F.col("o_orderkey") % 4
    cell = F.when(k == 0, "us$").when(k == 1, " Frw ").when(k == 2, "yen")
    marker = F.when(F.col("o_custkey") % 3 == 0, "USD").when(F.col("o_custkey") % 3 == 1, "RWF")
    header = F.when(F.col("o_orderkey") % 7 < 5, "RWF")
    rows = read(spark, sf_dir, "orders").select("o_orderkey", money.resolve_currency(cell, marker, F.lit(None).cast("string"), header).alias("c"))
    return rows.select("o_orderkey", "c.currency", "c.source", "c.reason")


@query("""SELECT c_custkey, array_to_string(list_sort(list_filter(regexp_split_to_array(lower(c_name || ' ' || c_mktsegment), '[^a-z]+'), lambda x: x <> '')), ' ') AS name_key,
 nullif(trim(regexp_replace(lower(c_name), '[^a-z0-9]+', ' ', 'g')), '') AS description_key FROM customer""")
def name_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order-free name keys and description keys; names come upper-case, reversed and with commas."""
    c = read(spark, sf_dir, "customer")
    typed = F.when(F.col("c_custkey") % 2 == 0, F.upper(F.concat_ws(" ", "c_name", "c_mktsegment"))).otherwise(F.concat_ws(",  ", "c_mktsegment", "c_name"))
    return c.select("c_custkey", text.name_key(typed).alias("name_key"), text.description_key(F.upper("c_name")).alias("description_key"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber % 4 = 0 THEN 'BAD_QUANTITY' WHEN l_linenumber % 4 = 1 THEN 'BAD_AMOUNT' WHEN l_linenumber % 4 = 2 THEN 'AMOUNT_MISMATCH' END AS reason,
 (l_quantity::DECIMAL(12,2))::DECIMAL(38,10) AS quantity FROM lineitem""")
def first_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase lines through the row parser; each bad row has the first failed check as its reason."""
    from tallybook.plans import rows as parse

    i = F.col("l_linenumber") % 4
    cell = lambda s: F.struct(F.lit("t").alias("kind"), s.cast("string").alias("s"))
    q, a = F.col("l_quantity").cast("decimal(12,2)"), F.col("l_extendedprice").cast("decimal(14,2)")
    price = F.when(i == 2, (a / q + 900).cast("decimal(14,4)")).when(i == 1, F.lit("7"))
    fields = {"po_number": F.lit("po 2019/1"), "supplier": F.lit("x"), "sku": F.lit("FAB COT 1"), "quantity": F.when(i == 0, F.concat(F.lit("-"), q)).otherwise(q.cast("string")), "amount": F.when(i == 1, "TBC").otherwise(a.cast("string")), "unit_price": price, "currency": F.lit("Frw")}
    cells = F.map_from_arrays(F.array(*[F.lit(f) for f in fields]), F.array(*[cell(v) for v in fields.values()]))
    lines = spread(read(spark, sf_dir, "lineitem"), "l_orderkey")
    given = lines.select(
        F.col("l_orderkey").alias("book"), F.col("l_linenumber").alias("sheet_index"), F.col("l_partkey").alias("row_num"), cells.alias("cells"), F.create_map().cast("map<string,string>").alias("hints"),
        F.to_date("l_shipdate").alias("date"), F.lit("iso").alias("date_method"), F.lit(None).cast("string").alias("date_reason"), q.alias("q0"),
    )
    out = parse.purchases(given)
    return out.select(F.col("book").alias("l_orderkey"), F.col("sheet_index").alias("l_linenumber"), F.col("row_num").alias("l_partkey"), "reason", F.abs("quantity").alias("quantity"))
