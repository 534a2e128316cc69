"""Survey reports, samples and relational operators over the order tables.

Roles: customers are the population (c_acctbal is the attribute), orders the sample (o_orderstatus the stage result),
lineitem the later stage; shards are slices of orders.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery.functions import scalars as S
from orrery.functions import stats
from orrery.operators import relational as rel
from orrery.operators import sampling, survey
from orrery.plans.base import Registry

R = Registry()
Z = stats.Z95


def wilson_sql(k: str, n: str) -> tuple[str, str]:
    centre = f"(({k})::DOUBLE / ({n}) + {Z * Z} / (2 * ({n}))) / (1 + {Z * Z} / ({n}))"
    half = f"{Z} * sqrt(({k})::DOUBLE / ({n}) * (1 - ({k})::DOUBLE / ({n})) / ({n}) + {Z * Z} / (4.0 * ({n}) * ({n}))) / (1 + {Z * Z} / ({n}))"
    return f"CASE WHEN ({n}) > 0 THEN greatest({centre} - {half}, 0.0) ELSE 0.0 END", f"CASE WHEN ({n}) > 0 THEN least({centre} + {half}, 1.0) ELSE 1.0 END"


LO, HI = wilson_sql("k", "n")
STAGES = """e AS (SELECT quantile_cont(c_acctbal, [0.2, 0.4, 0.6, 0.8]) AS e FROM customer), p AS (SELECT c_custkey AS key, len(list_filter(e, lambda x: x < c_acctbal)) AS stratum FROM customer, e),
s AS (SELECT DISTINCT o_custkey AS key FROM orders), u AS (SELECT DISTINCT o_custkey AS key FROM orders WHERE o_orderstatus <> 'P'), d AS (SELECT DISTINCT o_custkey AS key FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 250000),
f AS (SELECT s.key, stratum, u.key IS NOT NULL AS us, u.key IS NOT NULL AND d.key IS NOT NULL AS de FROM s JOIN p ON s.key = p.key LEFT JOIN u ON s.key = u.key LEFT JOIN d ON s.key = d.key),
w AS (SELECT stratum::INT AS stratum, count(*) AS population FROM p GROUP BY stratum), g AS (SELECT stratum, count(*) AS sampled, count(*) FILTER (us) AS usable, count(*) FILTER (de) AS deep FROM f GROUP BY stratum),
a AS (SELECT w.stratum, population, population::DOUBLE / sum(population) OVER () AS weight, coalesce(sampled, 0) AS sampled, coalesce(usable, 0) AS usable, coalesce(deep, 0) AS deep FROM w LEFT JOIN g ON w.stratum = g.stratum)"""


def audit(t):
    o = t.orders.withColumnRenamed("o_custkey", "key")
    people = t.customer.select(F.col("c_custkey").alias("key"), "c_acctbal")
    return survey.stratified_audit(people, "key", "c_acctbal", 5, o.select("key"), usable=o.filter("o_orderstatus <> 'P'").select("key"), deep=o.filter("o_orderstatus = 'F' AND o_totalprice > 250000").select("key"))


@R.add(f"WITH {STAGES} SELECT stratum, population, weight, sampled, usable, deep, CASE WHEN sampled > 0 THEN deep::DOUBLE / sampled END AS rate, {wilson_sql('deep', 'sampled')[0]} AS lo, {wilson_sql('deep', 'sampled')[1]} AS hi FROM a", ("weight", "rate", "lo", "hi"))
def stratified_audit(t):
    """The flagship: by fifth of the population, how many were sampled and passed each stage, with bounds."""
    return audit(t)


@R.add(f"WITH {STAGES} SELECT sum(weight * deep / nullif(sampled, 0)) AS weighted_rate, sum(deep)::DOUBLE / sum(sampled) AS raw_rate FROM a", ("weighted_rate", "raw_rate"))
def weighted_rate(t):
    return survey.weighted_rate(audit(t), "deep")


@R.add()
def posterior_rate(t):
    """Seeded Jeffreys draws over the strata: no SQL."""
    return survey.posterior_rate(audit(t), "deep")


@R.add("SELECT (SELECT count(*) FROM customer) AS people, (SELECT count(*) FROM orders) AS sampled, (SELECT count(*) FROM orders WHERE o_orderstatus <> 'P') AS usable, (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R') AS returned")
def funnel(t):
    return survey.funnel(people=(t.customer, None), sampled=(t.orders, None), usable=(t.orders, F.col("o_orderstatus") != "P"), returned=(t.lineitem, F.col("l_returnflag") == "R"))


@R.add("SELECT count(*) FILTER (o_orderkey % 10 = 0) AS sampled, count(*) FILTER (o_orderkey % 10 = 0 AND o_orderstatus = 'F') AS done FROM orders")
def funnel_delta(t):
    count = lambda df: survey.funnel(sampled=(df, None), done=(df, F.col("o_orderstatus") == "F"))
    return survey.delta(count(t.orders.filter("o_orderkey % 10 <> 0")), count(t.orders))


@R.add("WITH e AS (SELECT unnest(quantile_cont(c_acctbal, [0.2, 0.4, 0.6, 0.8])) AS edge FROM customer) SELECT edge FROM e", ("edge",))
def strata_edges(t):
    return stats.quantile_edges(t.customer, "c_acctbal", 5).select(F.explode("edges").alias("edge"))


@R.add(f"WITH c AS (SELECT o_orderpriority AS priority, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS k FROM orders GROUP BY 1) SELECT priority, k, n, k::DOUBLE / n AS rate, {LO} AS lo, {HI} AS hi FROM c", ("rate", "lo", "hi"))
def wilson_rates(t):
    got = t.orders.groupBy(F.col("o_orderpriority").alias("priority")).agg(stats.count_where(F.col("o_orderstatus") == "F").alias("k"), F.count(F.lit(1)).alias("n"))
    return got.select("priority", stats.rate("k", "n").alias("r")).select("priority", "r.*")


EDGES = [0.0, 1000.0, 50000.0, 100000.0, 200000.0, 300000.0, 900000.0]


@R.add(f"""WITH b AS (SELECT len(list_filter({EDGES}, lambda e: e <= o_totalprice)) AS bin, count(*) AS n FROM orders GROUP BY 1), e AS (SELECT unnest(range(1, {len(EDGES)}))::INT AS bin), t AS (SELECT count(*) AS t FROM orders)
SELECT e.bin, {EDGES}[e.bin]::DOUBLE AS lo, {EDGES}[e.bin + 1]::DOUBLE AS hi, coalesce(n, 0) AS n, coalesce(n, 0)::DOUBLE / t AS share FROM e LEFT JOIN b ON e.bin = b.bin, t""", ("share",))
def price_histogram(t):
    """Fixed bins [a, b), the empty ones included."""
    return survey.histogram(t.orders, "o_totalprice", EDGES)


@R.add(f"""WITH b AS (SELECT len(list_filter([0.0, 10.0, 20.0, 30.0, 50.0], lambda e: e < l_quantity)) AS bin, count(*) AS n FROM lineitem GROUP BY 1), e AS (SELECT unnest(range(1, 5))::INT AS bin), t AS (SELECT count(*) AS t FROM lineitem)
SELECT e.bin, [0.0, 10.0, 20.0, 30.0, 50.0][e.bin]::DOUBLE AS lo, [0.0, 10.0, 20.0, 30.0, 50.0][e.bin + 1]::DOUBLE AS hi, coalesce(n, 0) AS n, coalesce(n, 0)::DOUBLE / t AS share FROM e LEFT JOIN b ON e.bin = b.bin, t""", ("share",))
def quantity_histogram(t):
    """Fixed bins (a, b]."""
    return survey.histogram(t.lineitem, "l_quantity", [0.0, 10.0, 20.0, 30.0, 50.0], upper=False)


@R.add(f"""WITH x AS (SELECT o_orderstatus = 'F' AS hit, unnest([{{'d': 'all', 'v': 'all'}}, {{'d': 'priority', 'v': o_orderpriority}}, {{'d': 'year', 'v': year(o_orderdate)::VARCHAR}}]) AS d FROM orders), c AS (SELECT d.d AS dimension, d.v AS value, count(*) AS n, count(*) FILTER (hit) AS k FROM x GROUP BY 1, 2) SELECT dimension, value, n, k, k::DOUBLE / n AS rate, {LO} AS lo, {HI} AS hi FROM c""", ("rate", "lo", "hi"))
def recall_report(t):
    return survey.recall_by(t.orders, {"priority": F.col("o_orderpriority"), "year": F.year("o_orderdate")}, F.col("o_orderstatus") == "F")


@R.add("SELECT 'cheap' AS gate, count(*) FILTER (o_totalprice < 50000) AS n FROM orders UNION ALL SELECT 'open', count(*) FILTER (o_orderstatus = 'O') FROM orders UNION ALL SELECT 'urgent', count(*) FILTER (o_orderpriority = '1-URGENT') FROM orders")
def gate_counts(t):
    return survey.gate_counts(t.orders.select((F.col("o_totalprice") < 50000).alias("cheap"), (F.col("o_orderstatus") == "O").alias("open"), (F.col("o_orderpriority") == "1-URGENT").alias("urgent")), ["cheap", "open", "urgent"])


@R.add("""WITH a AS (SELECT o_orderkey AS k, o_orderstatus AS v FROM orders WHERE o_orderkey % 5 <> 0), b AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 = 0 THEN 'X' ELSE o_orderstatus END AS v FROM orders WHERE o_orderkey % 7 <> 0)
SELECT count(*) FILTER (a.k IS NOT NULL AND b.k IS NOT NULL) AS both, count(*) FILTER (b.k IS NULL) AS only_left, count(*) FILTER (a.k IS NULL) AS only_right, count(*) FILTER (a.k IS NOT NULL AND b.k IS NOT NULL AND a.v IS DISTINCT FROM b.v) AS differ FROM a FULL JOIN b ON a.k = b.k""")
def agreement(t):
    o = t.orders.select("o_orderkey", "o_orderstatus")
    b = o.filter("o_orderkey % 7 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 11 == 0, "X").otherwise(F.col("o_orderstatus")))
    return survey.agreement(o.filter("o_orderkey % 5 <> 0"), b, "o_orderkey", "o_orderstatus")


@R.add("SELECT l_returnflag AS truth, l_linestatus AS found, count(*) AS n FROM lineitem GROUP BY 1, 2")
def confusion(t):
    return survey.confusion(t.lineitem, F.col("l_returnflag"), F.col("l_linestatus"))


@R.add("""WITH p AS (SELECT 'price' AS quantity, abs(l_extendedprice - 1000 * l_quantity) / nullif(300 * l_quantity, 0) AS pull FROM lineitem UNION ALL SELECT 'tax', abs(l_tax - 0.04) / nullif(l_discount, 0) FROM lineitem)
SELECT quantity, count(*) AS n, avg((pull <= 1)::INT) AS within1, avg((pull <= 2)::INT) AS within2, quantile_cont(pull, 0.6827) AS inflation FROM p WHERE pull IS NOT NULL GROUP BY 1""", ("within1", "within2", "inflation"))
def interval_coverage(t):
    c = F.col
    return survey.coverage_of_intervals(t.lineitem, {"price": (c("l_extendedprice"), 300 * c("l_quantity"), 1000 * c("l_quantity")), "tax": (c("l_tax"), c("l_discount"), F.lit(0.04))})


@R.add("""WITH m AS (SELECT count(*) FILTER (l_quantity <= 5) AS n1, count(*) FILTER (l_quantity <= 5 AND l_returnflag = 'R') AS k1, count(*) FILTER (l_quantity > 5) AS n2, count(*) FILTER (l_quantity > 5 AND l_returnflag = 'R') AS k2 FROM lineitem)
SELECT *, k1::DOUBLE / n1 AS rate1, k2::DOUBLE / n2 AS rate2, pow(1 - k2::DOUBLE / n2, n1) AS p_none, n1 * ln(1 - k2::DOUBLE / n2) AS ln_p_none FROM m""", ("rate1", "rate2", "p_none", "ln_p_none"))
def group_contrast(t):
    return survey.contrast(t.lineitem, F.col("l_quantity") <= 5, F.col("l_returnflag") == "R")


@R.add("""WITH c AS (SELECT n_nationkey AS k, 24 AS n FROM nation WHERE n_nationkey <= 24), x AS (SELECT k, n, unnest(range(0, 25)) AS i FROM c), t AS (SELECT k, n, i, (factorial(n) / (factorial(i::INT) * factorial((n - i)::INT)))::DOUBLE * pow(0.3, i) * pow(0.7, n - i) AS p FROM x WHERE i >= k)
SELECT k AS nation, CASE WHEN k <= 0 THEN 1.0 ELSE sum(p) END AS tail FROM t GROUP BY k, n""", ("tail",))
def binomial_tail(t):
    return t.nation.select(F.col("n_nationkey").alias("nation"), stats.binomial_tail("n_nationkey", F.lit(24), F.lit(0.3)).alias("tail"))


@R.add("SELECT count(*) AS count, avg(o_totalprice) AS mean, stddev_samp(o_totalprice) AS std, min(o_totalprice) AS min, quantile_cont(o_totalprice, 0.25) AS q25, quantile_cont(o_totalprice, 0.5) AS q50, quantile_cont(o_totalprice, 0.75) AS q75, max(o_totalprice) AS max FROM orders", ("mean", "std", "min", "q25", "q50", "q75", "max"), 3)
def described(t):
    return rel.describe(t.orders, "o_totalprice")


@R.add("WITH g AS (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) SELECT sum(n)::BIGINT AS n_rows, count(*) AS n_keys, (sum(n) - count(*))::BIGINT AS n_surplus FROM g")
def duplicate_keys(t):
    return rel.duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


@R.add("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2")
def status_counts(t):
    return rel.value_counts(t.orders, "o_orderstatus", "o_orderpriority")


@R.add("SELECT CASE WHEN grouping(l_returnflag) = 1 THEN 'ALL' ELSE l_returnflag END AS l_returnflag, CASE WHEN grouping(l_linestatus) = 1 THEN 'ALL' ELSE l_linestatus END AS l_linestatus, count(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def crosstab_margins(t):
    return rel.crosstab(t.lineitem, "l_returnflag", "l_linestatus")


@R.add("""SELECT 'o_orderstatus' AS "grouping", o_orderstatus, NULL::VARCHAR AS o_orderpriority, count(*) AS n FROM orders GROUP BY 2 UNION ALL SELECT 'o_orderpriority', NULL, o_orderpriority, count(*) FROM orders GROUP BY 3 UNION ALL SELECT 'o_orderstatus|o_orderpriority', o_orderstatus, o_orderpriority, count(*) FROM orders GROUP BY 2, 3""")
def grouping_counts(t):
    return rel.grouping_counts(t.orders, [["o_orderstatus"], ["o_orderpriority"], ["o_orderstatus", "o_orderpriority"]])


@R.add("""WITH b AS (SELECT o_orderkey, o_custkey, 0 AS p FROM orders WHERE o_orderkey % 3 <> 1), x AS (SELECT o_orderkey, -o_custkey AS o_custkey, 1 AS p FROM orders WHERE o_orderkey % 3 <> 0), u AS (SELECT * FROM b UNION ALL SELECT * FROM x) SELECT o_orderkey, arg_min(o_custkey, p) AS o_custkey FROM u GROUP BY 1""")
def union_by_key(t):
    """The base wins; other shards only add keys. Both together hold all orders, a third of them twice."""
    o = t.orders.select("o_orderkey", "o_custkey")
    return rel.union_by_key(o.filter("o_orderkey % 3 <> 1"), [o.filter("o_orderkey % 3 <> 0").withColumn("o_custkey", -F.col("o_custkey"))], ["o_orderkey"])


@R.add("""WITH b AS (SELECT DISTINCT o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 3 <> 1), x AS (SELECT DISTINCT o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 3 <> 0) SELECT * FROM b UNION SELECT * FROM x""")
def union_by_composite_key(t):
    o = t.orders.select("o_custkey", "o_orderstatus")
    cut = lambda m: t.orders.filter(f"o_orderkey % 3 <> {m}").select("o_custkey", "o_orderstatus").distinct()
    return rel.union_by_key(cut(1), [cut(0)], o.columns)


@R.add("SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def union_distinct_rows(t):
    o = t.orders.select("o_custkey", "o_orderstatus")
    return rel.union_by_key(o, [o], None)


@R.add("SELECT o_custkey, arg_max(o_orderkey, o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY 1")
def last_write_wins(t):
    return rel.last_wins(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], "o_orderkey")


@R.add("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'new' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def upsert_parts(t):
    o = t.orders.select("o_orderkey", "o_orderstatus")
    return rel.upsert([o, o.filter("o_orderkey % 4 = 0").withColumn("o_orderstatus", F.lit("new"))], ["o_orderkey"])


@R.add("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def resume_todo(t):
    """What has no finished result yet; failed ones are tried again."""
    return rel.todo(t.customer.select("c_custkey", "c_name"), t.orders.withColumnRenamed("o_custkey", "c_custkey"), ["c_custkey"], F.col("o_orderstatus") == "F")


@R.add("SELECT s_suppkey, s_name, n_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey")
def key_lookup(t):
    side = t.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return rel.lookup(t.supplier, side, ["s_nationkey"], ["n_name"]).select("s_suppkey", "s_name", "n_name")


@R.add("SELECT c_custkey, coalesce(status, 'NOT_CHECKED') AS status FROM customer LEFT JOIN (SELECT o_custkey, 'CHECKED' AS status FROM orders GROUP BY 1) ON c_custkey = o_custkey")
def absent_filled(t):
    found = t.orders.select(F.col("o_custkey").alias("c_custkey")).distinct().withColumn("status", F.lit("CHECKED"))
    return rel.fill_absent(t.customer.select("c_custkey"), found, ["c_custkey"], "status", "NOT_CHECKED")


@R.add("SELECT n_nationkey AS k, n_name AS name FROM nation WHERE n_nationkey < 10 UNION ALL SELECT n_nationkey, 'control' FROM nation WHERE n_nationkey >= 10")
def controls_appended(t):
    n = t.nation.select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"))
    return rel.append_missing(n.filter("k < 10"), n.withColumn("name", F.lit("control")), ["k"])


@R.add("SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders) AS ordered, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') AS pending FROM customer")
def membership_flags(t):
    o = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    return rel.in_any(t.customer.select("c_custkey"), ["c_custkey"], ordered=o.select("c_custkey"), pending=o.filter("o_orderstatus = 'P'").select("c_custkey"))


@R.add("""WITH a AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_totalprice AS p FROM orders WHERE o_orderkey % 5 <> 0), b AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 11 = 0 THEN 'X' ELSE o_orderstatus END AS s, o_totalprice * CASE WHEN o_orderkey % 13 = 0 THEN 1.1 ELSE 1 + 1e-9 END AS p FROM orders WHERE o_orderkey % 7 <> 0), j AS (SELECT coalesce(a.k, b.k) AS k, a.k AS ka, b.k AS kb, a.s AS sa, b.s AS sb, a.p AS pa, b.p AS pb FROM a FULL JOIN b ON a.k = b.k)
SELECT k, '__row' AS "column" FROM j WHERE ka IS NULL OR kb IS NULL UNION ALL SELECT k, 's' FROM j WHERE ka IS NOT NULL AND kb IS NOT NULL AND sa <> sb UNION ALL SELECT k, 'p' FROM j WHERE ka IS NOT NULL AND kb IS NOT NULL AND abs(pa - pb) > 1e-6 * greatest(1, abs(pb))""")
def tolerant_differences(t):
    o = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"), F.col("o_totalprice").alias("p"))
    b = o.filter("k % 7 <> 0").withColumns({"s": F.when(F.col("k") % 11 == 0, "X").otherwise(F.col("s")), "p": F.col("p") * F.when(F.col("k") % 13 == 0, 1.1).otherwise(1 + 1e-9)})
    return rel.differences(o.filter("k % 5 <> 0"), b, ["k"], ["s", "p"]).select("k", "column")


@R.add("""SELECT n_name AS name, sha256(n_nationkey::VARCHAR || chr(31) || n_name || chr(31) || n_regionkey::VARCHAR) AS digest FROM nation""")
def row_digests(t):
    return t.nation.select(F.col("n_name").alias("name"), rel.row_digest(["n_nationkey", "n_name", "n_regionkey"]).alias("digest"))


@R.add("""WITH d AS (SELECT n_name || chr(9) || sha256(n_nationkey::VARCHAR || chr(31) || n_name) AS line FROM nation) SELECT sha256(string_agg(line, chr(10) ORDER BY line) || chr(10)) AS bundle_sha256 FROM d""")
def frozen_bundle(t):
    return rel.bundle_digest(t.nation.select("n_name", rel.row_digest(["n_nationkey", "n_name"]).alias("digest")), "n_name", "digest")


@R.add("SELECT n_name AS name, CASE WHEN n_nationkey % 5 = 0 THEN 'missing' WHEN n_nationkey % 6 = 0 THEN 'extra' WHEN n_nationkey % 7 = 0 THEN 'changed' ELSE 'same' END AS status FROM nation")
def bundle_verified(t):
    n = t.nation.select(F.col("n_name").alias("name"), "n_nationkey", rel.row_digest(["n_name"]).alias("digest"))
    k = F.col("n_nationkey")
    now = n.filter(k % 5 != 0).withColumn("digest", F.when(k % 7 == 0, "x").otherwise(F.col("digest")))
    return rel.verify_bundle(n.filter((k % 6 != 0) | (k == 0)), now, "name", "digest")


@R.add("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 15")
def top_report(t):
    return rel.top_n(t.orders.select("o_orderkey", "o_totalprice"), 15, F.col("o_totalprice").desc(), F.col("o_orderkey"))


@R.add("""WITH m AS (SELECT o_orderkey, unnest([{'c': 'dearest', 'v': o_totalprice}, {'c': 'cheapest', 'v': -o_totalprice}, {'c': 'latest', 'v': date_diff('day', DATE '1970-01-01', o_orderdate::DATE)::DOUBLE}]) AS m FROM orders) SELECT m.c AS category, arg_max(o_orderkey, (m.v, -o_orderkey)) AS o_orderkey, max(m.v) AS value FROM m GROUP BY 1""", ("value",), 2)
def best_per_category(t):
    o = t.orders.select(F.col("o_orderkey").alias("name"), "o_orderkey", "o_totalprice", "o_orderdate")
    day = F.datediff("o_orderdate", F.lit("1970-01-01"))
    got = rel.best_per_category(o, "name", {"dearest": F.col("o_totalprice"), "cheapest": -F.col("o_totalprice"), "latest": day}, "o_orderkey")
    return got.withColumnRenamed("name", "o_orderkey")


@R.add("""SELECT 'keys' AS name, count(*) = count(DISTINCT o_orderkey) AS ok, count(*)::VARCHAR AS detail FROM orders UNION ALL SELECT 'prices', min(o_totalprice) > 0, count(*)::VARCHAR FROM orders""")
def readiness_checklist(t):
    n = F.count(F.lit(1)).alias("detail")
    return rel.checklist(("keys", t.orders.agg((F.count(F.lit(1)) == F.countDistinct("o_orderkey")).alias("ok"), n)), ("prices", t.orders.agg((F.min("o_totalprice") > 0).alias("ok"), n)))


@R.add("SELECT o_custkey, o_orderkey, o_totalprice FROM orders")
def nested_to_rows(t):
    """Nested documents flattened: one struct array a customer, exploded again."""
    docs = t.orders.groupBy("o_custkey").agg(F.collect_list(F.struct("o_orderkey", "o_totalprice")).alias("orders"))
    return rel.flat(docs, ["o_custkey"], "orders")


@R.add("""SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING' AND contains(c_name, '1') ORDER BY c_acctbal DESC""")
def candidate_browser(t):
    return t.customer.filter((F.col("c_mktsegment") == "BUILDING") & F.contains("c_name", F.lit("1"))).select("c_custkey", "c_name", "c_acctbal").orderBy(F.col("c_acctbal").desc(), "c_custkey")


@R.add("""WITH n AS (SELECT o_custkey, coalesce(min(o_orderdate) FILTER (o_orderdate >= TIMESTAMP '1996-01-01'), max(o_orderdate)) AS next_date FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1) SELECT o_custkey, date_diff('day', DATE '1970-01-01', next_date::DATE) AS next_day FROM n""")
def upcoming_board(t):
    """Per key the earliest date from a day on, else the last."""
    o = t.orders.filter("o_orderstatus <> 'P'")
    ahead = F.min(F.when(F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz"), F.col("o_orderdate")))
    return o.groupBy("o_custkey").agg(F.coalesce(ahead, F.max("o_orderdate")).alias("d")).select("o_custkey", F.datediff("d", F.lit("1970-01-01")).cast("long").alias("next_day"))


# -- samples ----------------------------------------------------------------------------------------------------------


def draw_sql(seed, *xs: str) -> str:
    text = " || ':' || ".join([f"'{seed}'", *[f"({x})::VARCHAR" for x in xs]])
    return f"(('0x' || substr(md5({text}), 1, 13))::BIGINT::DOUBLE / {float(1 << 52)})"


@R.add(f"""WITH e AS (SELECT quantile_cont(c_acctbal, [0.2, 0.4, 0.6, 0.8]) AS e FROM customer), s AS (SELECT c_custkey, len(list_filter(e, lambda x: x < c_acctbal))::INT AS stratum FROM customer, e), x AS (SELECT * FROM s WHERE c_custkey % 10 <> 3), r AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY {draw_sql(42, 'c_custkey')}, c_custkey) AS n FROM x)
SELECT c_custkey, stratum FROM r WHERE n <= 8 + CASE WHEN stratum < 2 THEN 1 ELSE 0 END""")
def stratified_sample(t):
    """Quotas by quantile stratum, without the keys drawn before."""
    drawn = t.customer.filter("c_custkey % 10 = 3").select("c_custkey")
    return sampling.stratified(t.customer.select("c_custkey", "c_acctbal"), "c_custkey", "c_acctbal", 5, 42, 42, drawn).select("c_custkey", "stratum")


@R.add(f"""WITH e AS (SELECT quantile_cont(c_acctbal, [0.25, 0.5, 0.75]) AS e FROM customer WHERE c_mktsegment = 'BUILDING'), s AS (SELECT c_custkey, len(list_filter(e, lambda x: x < c_acctbal))::INT AS stratum FROM customer, e WHERE c_mktsegment = 'BUILDING'), r AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY {draw_sql(7, 'c_custkey')}, c_custkey) AS n FROM s) SELECT c_custkey, stratum FROM r WHERE n <= 3""")
def host_pick(t):
    return sampling.pick_hosts(t.customer.withColumn("ok", F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_acctbal", "ok"), "c_custkey", "c_acctbal", "ok", 4, 12, 7).select("c_custkey", "stratum")


@R.add("WITH r AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) AS n FROM supplier) SELECT s_suppkey FROM r WHERE (n - 1) % 4 = 1")
def shard_slice(t):
    return sampling.shard(t.supplier.select("s_suppkey"), "s_suppkey", *sampling.parse_shard("1/4"))


@R.add(f"SELECT o_orderkey FROM orders WHERE floor({draw_sql(0, 'o_orderkey')} * 8) = 3")
def hash_shard(t):
    return sampling.shard_by_hash(t.orders.select("o_orderkey"), "o_orderkey", 3, 8)


@R.add(f"WITH r AS (SELECT l_orderkey, l_returnflag, row_number() OVER (PARTITION BY l_returnflag ORDER BY {draw_sql(9, 'l_orderkey')}, l_orderkey) AS n FROM (SELECT DISTINCT l_orderkey, l_returnflag FROM lineitem)) SELECT l_orderkey, l_returnflag FROM r WHERE n <= 20")
def balanced_pick(t):
    return sampling.balanced(t.lineitem.select("l_orderkey", "l_returnflag").distinct(), "l_orderkey", "l_returnflag", 20, 9)


@R.add(f"WITH r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY {draw_sql(5, 'user_id', 'event_id')}, event_id) AS n FROM events) SELECT user_id, event_id FROM r WHERE n <= 10")
def point_subsample(t):
    return sampling.subsample(t.events.select("user_id", "event_id"), "user_id", "event_id", 10, 5)


@R.add(f"""WITH n AS (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS n FROM events), b AS (SELECT *, n // 5 AS blk FROM n), m AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY {draw_sql(3, 'user_id', 'blk')}, blk, n) - 1 AS m FROM b) SELECT n.user_id, event_id, m.value AS value FROM n JOIN m ON n.user_id = m.user_id AND n = m""")
def block_shuffle(t):
    return sampling.block_shuffle(t.events.select("user_id", "event_id", "value"), "user_id", "event_id", "value", 5, 3)


@R.add(f"""WITH h AS (SELECT s_suppkey AS key, unnest(range(0, 3))::INT AS k FROM supplier) SELECT key, k, 0.5 * pow(26, {draw_sql('11-period', 'key', 'k')}) AS period, 0.002 * pow(250, {draw_sql('11-depth', 'key', 'k')}) AS depth, 0.02 + (0.1 - 0.02) * {draw_sql('11-duration', 'key', 'k')} AS duration_fraction, {draw_sql('11-t0', 'key', 'k')} AS t0_fraction FROM h""", ("period", "depth", "duration_fraction", "t0_fraction"))
def injection_draws(t):
    return sampling.injections(t.supplier.select(F.col("s_suppkey").alias("key")), "key", 3, 11)


# -- screening --------------------------------------------------------------------------------------------------------


@R.add("""WITH s AS (SELECT (l_quantity / 51)::DOUBLE AS score, (l_returnflag = 'R')::INT AS y FROM lineitem), g AS (SELECT round((i + 1) / 100.0, 6)::DOUBLE AS threshold FROM range(0, 96) r(i)), m AS (SELECT threshold, count(*) FILTER (score >= threshold AND y = 1)::DOUBLE / count(*) FILTER (y = 1) AS recall, avg((score < threshold)::INT) AS skipped FROM s, g GROUP BY 1), w AS (SELECT unnest([0.95, 0.9, 0.8])::DOUBLE AS wanted)
SELECT wanted, max(threshold) AS threshold, arg_max(recall, threshold) AS recall, arg_max(skipped, threshold) AS skipped FROM m, w WHERE recall >= wanted GROUP BY wanted""", ("threshold", "recall", "skipped"))
def screening_thresholds(t):
    scored = t.lineitem.select((F.col("l_quantity") / 51).alias("score"), (F.col("l_returnflag") == "R").cast("int").alias("y"))
    return survey.screening(scored, "score", "y")


@R.add()
def classifier_folds(t):
    """Two classifiers, cross-validated by hashed folds."""
    rows = t.lineitem.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("key"), (F.col("l_returnflag") == "R").cast("int").alias("y"), "l_quantity", "l_extendedprice", "l_discount", "l_linestatus")
    return survey.cross_validated(rows.dropDuplicates(["key"]), "key", "y", ["l_quantity", "l_extendedprice", "l_discount"], ["l_linestatus"], folds=2).withColumn("auc", F.round("auc", 2))


@R.add("SELECT threshold, count(*) FILTER (l_quantity >= threshold) AS n FROM lineitem, (VALUES (10.0::DOUBLE), (25.0), (40.0)) v(threshold) GROUP BY 1")
def counts_above(t):
    return survey.bisected(t.lineitem, "l_quantity", [10.0, 25.0, 40.0])


@R.add("SELECT count(*) AS n, count(*) FILTER (l_discount > 0.05) AS deep, count(*) FILTER (l_tax IS NULL) AS untaxed FROM lineitem")
def conditional_counts(t):
    return survey.counts_where(t.lineitem, deep=F.col("l_discount") > 0.05, untaxed=F.col("l_tax").isNull())


@R.add("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events")
def json_numbers(t):
    from orrery.sources.text import numbers_of

    return t.events.select("event_id", *numbers_of(F.col("props"), ["k"]))


@R.add("""WITH g AS (SELECT user_id, ts, value, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 6 HOUR THEN 1 ELSE 0 END AS new FROM events), s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM g)
SELECT user_id, epoch_us(min(ts)) AS start_us, count(*) AS n, avg(value) AS mean FROM s GROUP BY user_id, s""", ("mean",))
def gap_sessions(t):
    from orrery.streaming.gaps import gap_sessions as sessions

    rows = t.events.withColumn("at", F.col("ts").cast("timestamp"))
    return sessions(rows, "user_id", "at", "value").select("user_id", F.unix_micros("start").alias("start_us"), "n", "mean")
