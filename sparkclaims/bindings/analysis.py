"""Aggregates, windows, subtotals and dashboard figures."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparkclaims.bindings.registry import query
from sparkclaims.bindings.tables import TIE, TIE_SQL, Tables, claim_id
from sparkclaims.operators import sketches
from sparkclaims.operators.summary import latest_summary, refresh_batch, refresh_incremental, write_summary
from sparkclaims.plans import dashboards, reports
from sparkclaims.plans.star import ClaimStar
from sparkclaims.storage import scratch_path

JOINED = """FROM claims c JOIN policies p ON c.policy_id = p.policy_id
       JOIN policy_types y ON p.policy_type_id = y.policy_type_id
       JOIN dates d ON c.date_key = d.date_key
       JOIN agents a ON c.agent_id = a.agent_id"""
LEFT_JOINED = """FROM claims c LEFT JOIN policies p ON c.policy_id = p.policy_id
       LEFT JOIN policy_types y ON p.policy_type_id = y.policy_type_id
       LEFT JOIN agents a ON c.agent_id = a.agent_id
       LEFT JOIN customers u ON p.customer_id = u.customer_id"""


def exact(total: str, rows: str, scale: int, digits: int) -> str:
    """total / rows rounded half away from zero, in integers; total has ``scale`` places."""
    up, one = 10**digits, 10**scale
    units = f"CAST(({total}) * {one} AS HUGEINT)"
    return (
        f"CAST(sign({units}) * ((2 * abs({units}) * {up} + {one} * ({rows})) // nullif(2 * {one} * ({rows}), 0))"
        f" AS DOUBLE) / {up}"
    )


SCORE_4 = exact("SUM(fraud_score)", "COUNT(fraud_score)", 4, 4)
FRAUD_2 = exact("100 * SUM(fraud)", "COUNT(*)", 0, 2)
AVG_SCORE = "CAST(SUM(fraud_score) AS DOUBLE) / COUNT(fraud_score)"
FRAUD_PCT = "100.0 * CAST(SUM(fraud) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)"


@query(
    "claims_by_type",
    f"""SELECT claim_type, COUNT(*) AS claim_count,
         {exact('SUM(claimed_amount)', 'COUNT(*)', 2, 2)} AS avg_claimed,
         {exact('SUM(approved_amount)', 'COUNT(*)', 4, 2)} AS avg_approved,
         {SCORE_4} AS avg_fraud_score, CAST(SUM(fraud) AS BIGINT) AS fraud_count,
         {FRAUD_2} AS fraud_pct,
         {exact('SUM(processing_days)', 'COUNT(*)', 0, 1)} AS avg_processing_days
       FROM claims GROUP BY claim_type""",
)
def claims_by_type(t: Tables):
    return reports.claims_by_type(t.claims)


@query(
    "fraud_by_category",
    f"""SELECT category, COUNT(*) AS total_claims, CAST(SUM(fraud) AS BIGINT) AS fraud_claims,
         {FRAUD_2} AS fraud_rate_pct, {SCORE_4} AS avg_fraud_score,
         {exact('SUM(claimed_amount)', 'COUNT(*)', 2, 2)} AS avg_claim_amount
       FROM claims c LEFT JOIN policies p ON c.policy_id = p.policy_id
       LEFT JOIN policy_types y ON p.policy_type_id = y.policy_type_id GROUP BY category""",
)
def fraud_by_category(t: Tables):
    return reports.fraud_by_category(t.star)


@query(
    "running_fraud",
    f"""SELECT claim_id, claim_type, CAST(claim_date AS VARCHAR) AS claim_date, fraud_flag,
         CAST(fraud_score AS DOUBLE) AS fraud_score,
         CAST(SUM(fraud) OVER w AS BIGINT) AS running_fraud_count,
         {exact('SUM(fraud_score) OVER w', 'COUNT(*) OVER w', 4, 4)} AS running_fraud_score_avg
       FROM claims
       WINDOW w AS (PARTITION BY claim_type ORDER BY claim_date, {TIE_SQL}
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def running_fraud(t: Tables):
    rows = reports.running_fraud(t.claims, TIE, keep=TIE)
    return rows.withColumn("claim_id", claim_id()).select(
        "claim_id", "claim_type", "claim_date", "fraud_flag", "fraud_score",
        "running_fraud_count", "running_fraud_score_avg",
    )


@query(
    "risk_label_counts",
    """SELECT CASE WHEN r >= 0.7 THEN 'CRITICAL' WHEN r >= 0.5 THEN 'HIGH'
           WHEN r >= 0.3 THEN 'MEDIUM' ELSE 'LOW' END AS risk_label, COUNT(*) AS claim_count
       FROM (SELECT round_even(CAST(fraud_score AS DOUBLE) * 0.5
         + least(CAST(claimed_amount AS DOUBLE) / 500000, 1.0) * 0.3
         + least(CAST(processing_days AS DOUBLE) / 120, 1.0) * 0.2, 4) AS r FROM claims)
       GROUP BY 1""",
)
def risk_label_counts(t: Tables):
    return reports.risk_label_counts(t.claims)


@query(
    "fraud_type_counts",
    "SELECT claim_type, COUNT(*) AS count FROM claims WHERE fraud_flag GROUP BY claim_type",
)
def fraud_type_counts(t: Tables):
    return reports.fraud_type_counts(t.claims)


@query(
    "customer_risk",
    f"""WITH m AS (SELECT u.customer_id, u.full_name, u.credit_band, u.income_band,
           COUNT(*) AS total_claims, SUM(claimed_amount) AS s, {AVG_SCORE} AS a, {SCORE_4} AS a4,
           CAST(SUM(fraud) AS BIGINT) AS fraud_claim_count
         FROM claims c JOIN policies p ON c.policy_id = p.policy_id
         JOIN customers u ON p.customer_id = u.customer_id GROUP BY 1, 2, 3, 4),
       r AS (SELECT *, CASE WHEN a >= 0.7 OR fraud_claim_count >= 3 THEN 'CRITICAL'
           WHEN a >= 0.4 OR total_claims >= 5 THEN 'HIGH'
           WHEN a >= 0.2 OR total_claims >= 3 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level FROM m)
       SELECT customer_id, full_name, credit_band, income_band, total_claims,
         CAST(round(s, 2) AS DOUBLE) AS total_claimed, a4 AS avg_fraud_score,
         fraud_claim_count, risk_level FROM r WHERE risk_level IN ('CRITICAL', 'HIGH')""",
)
def customer_risk(t: Tables):
    return reports.customer_risk(t.star)


@query(
    "monthly_trend_window",
    f"""WITH m AS (SELECT d.year, d.month, d.month_name, policy_type_name, COUNT(*) AS claim_count,
           SUM(claimed_amount) AS s {JOINED} GROUP BY 1, 2, 3, 4)
       SELECT year, month, month_name, policy_type_name, claim_count,
         CAST(s AS DOUBLE) AS total_claimed,
         CAST(SUM(claim_count) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS ytd_claim_count,
         CAST(SUM(s) OVER (w ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS ytd_claimed_amount,
         lag(claim_count) OVER w AS prev_month_count,
         {exact('100 * (claim_count - lag(claim_count) OVER w)', 'lag(claim_count) OVER w', 0, 2)} AS mom_growth_pct,
         rank() OVER (PARTITION BY year, month ORDER BY s DESC) AS rank_by_amount
       FROM m WINDOW w AS (PARTITION BY policy_type_name, year ORDER BY month)""",
)
def monthly_trend_window(t: Tables):
    return reports.monthly_trend(t.star)


@query(
    "next_month_lead",
    f"""WITH m AS (SELECT d.year, d.month, policy_type_name, COUNT(*) AS claim_count {JOINED} GROUP BY 1, 2, 3)
       SELECT *, lead(claim_count) OVER (PARTITION BY policy_type_name ORDER BY year, month)
         AS next_month_count FROM m""",
)
def next_month_lead(t: Tables):
    return reports.next_month(t.star)


@query(
    "fraud_percentile",
    f"""SELECT claim_id, CAST(claimed_amount AS DOUBLE) AS claimed_amount,
         CAST(fraud_score AS DOUBLE) AS fraud_score, c.status, policy_type_name,
         coalesce({exact('100 * (rank() OVER (PARTITION BY p.policy_type_id ORDER BY fraud_score) - 1)',
                         'COUNT(*) OVER (PARTITION BY p.policy_type_id) - 1', 0, 2)}, 0) AS fraud_percentile,
         {exact('SUM(fraud_score) OVER w', 'COUNT(*) OVER w', 4, 4)} AS rolling_avg_fraud_score
       FROM (SELECT *, policy_id AS pid FROM claims) c JOIN policies p ON c.policy_id = p.policy_id
       JOIN policy_types y ON p.policy_type_id = y.policy_type_id
       WINDOW w AS (PARTITION BY p.policy_type_id ORDER BY date_key, pid, line_no, part_id, agent_id,
         claimed_amount, claim_date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)""",
)
def fraud_percentile(t: Tables):
    rows = reports.fraud_percentile(t.star, TIE, keep=TIE)
    return rows.withColumn("claim_id", claim_id()).select(
        "claim_id", "claimed_amount", "fraud_score", "status", "policy_type_name",
        "fraud_percentile", "rolling_avg_fraud_score",
    )


@query(
    "risk_quartile",
    f"""SELECT claim_id, CAST(fraud_score AS DOUBLE) AS fraud_score,
         ntile(4) OVER (ORDER BY fraud_score DESC, {TIE_SQL}) AS risk_quartile FROM claims""",
)
def risk_quartile(t: Tables):
    rows = reports.risk_quartile(t.claims, TIE, keep=TIE)
    return rows.withColumn("claim_id", claim_id()).select("claim_id", "fraud_score", "risk_quartile")


@query(
    "claims_rollup",
    f"""SELECT CASE WHEN grouping(region) = 1 THEN 'ALL REGIONS' ELSE region END AS region,
         CASE WHEN grouping(policy_type_name) = 1 THEN 'ALL POLICIES' ELSE policy_type_name END AS policy_type,
         CASE WHEN grouping(d.year) = 1 THEN 'ALL YEARS' ELSE CAST(d.year AS VARCHAR) END AS year,
         CAST(grouping(region, policy_type_name, d.year) AS BIGINT) AS grouping_id,
         COUNT(*) AS total_claims, CAST(round(SUM(claimed_amount), 2) AS DOUBLE) AS total_claimed,
         CAST(round(SUM(approved_amount), 2) AS DOUBLE) AS total_approved,
         {exact("""100 * SUM(CAST(round_even(CASE WHEN claimed_amount > 0 THEN CAST(approved_amount AS DOUBLE)
           / CAST(claimed_amount AS DOUBLE) ELSE 0 END, 4) AS DECIMAL(12,4)))""", 'COUNT(*)', 4, 2)} AS avg_payout_pct,
         CAST(SUM(fraud) AS BIGINT) AS fraud_claims
       {JOINED} GROUP BY ROLLUP(region, policy_type_name, d.year)""",
)
def claims_rollup(t: Tables):
    return reports.claims_rollup(t.star)


@query(
    "fraud_cube",
    f"""SELECT CASE WHEN grouping(age_band) = 1 THEN 'ALL' ELSE age_band END AS age_band,
         CASE WHEN grouping(gender) = 1 THEN 'ALL' ELSE gender END AS gender,
         CASE WHEN grouping(category) = 1 THEN 'ALL' ELSE category END AS policy_category,
         CAST(grouping(age_band, gender, category) AS BIGINT) AS grouping_id,
         COUNT(*) AS claim_count, CAST(SUM(fraud) AS BIGINT) AS fraud_count,
         {FRAUD_2} AS fraud_rate_pct, {SCORE_4} AS avg_fraud_score
       FROM claims c JOIN policies p ON c.policy_id = p.policy_id
       JOIN policy_types y ON p.policy_type_id = y.policy_type_id
       JOIN customers u ON p.customer_id = u.customer_id
       GROUP BY CUBE(age_band, gender, category)""",
)
def fraud_cube(t: Tables):
    return reports.fraud_cube(t.star)


SUMMARY = f"""SELECT d.year, d.quarter, policy_type_name, region, COUNT(*) AS claim_count,
         CAST(SUM(claimed_amount) AS DOUBLE) AS total_claimed,
         CAST(SUM(approved_amount) AS DOUBLE) AS total_approved,
         {AVG_SCORE} AS avg_fraud_score, CAST(SUM(fraud) AS BIGINT) AS fraud_count
       {JOINED} GROUP BY 1, 2, 3, 4"""
FRAUD_SUMMARY = f"""SELECT d.year, d.quarter, policy_type_name, region, COUNT(*) AS claim_count,
         CAST(SUM(fraud) AS BIGINT) AS fraud_count, {SCORE_4} AS avg_fraud_score,
         CAST(round(SUM(claimed_amount), 2) AS DOUBLE) AS total_claimed,
         CAST(round(SUM(approved_amount), 2) AS DOUBLE) AS total_approved
       {JOINED} GROUP BY 1, 2, 3, 4"""


@query("mv_claim_summary", SUMMARY)
def mv_claim_summary(t: Tables):
    base = scratch_path(t.spark, "claim_summary")
    path = write_summary(reports.summary_sums(t.star), base, 1)
    return reports.claim_summary(t.spark.read.parquet(path))


@query("mv_incremental", SUMMARY)
def mv_incremental(t: Tables):
    """The summary of claims before 1999, refreshed with the later ones."""
    base = scratch_path(t.spark, "claim_summary")
    star = t.star

    def part(condition):
        return reports.summary_sums(
            ClaimStar(
                star.claims.filter(condition), star.policies, star.customers,
                star.policy_types, star.agents, star.dates,
            )
        )

    write_summary(part(F.col("date_key") < 19990101), base, 1)
    refreshed = refresh_incremental(t.spark, base, 2, part(F.col("date_key") >= 19990101))
    return reports.claim_summary(refreshed)


@query("mv_fraud_summary", FRAUD_SUMMARY)
def mv_fraud_summary(t: Tables):
    return reports.fraud_summary(reports.summary_sums(t.star))


@query(
    "mv_fraud_query",
    f"SELECT * FROM ({FRAUD_SUMMARY}) WHERE year = 2000 AND fraud_count > 10",
)
def mv_fraud_query(t: Tables):
    path = write_summary(reports.summary_sums(t.star), scratch_path(t.spark, "fraud_summary"), 1)
    summary = reports.fraud_summary(t.spark.read.parquet(path))
    return reports.fraud_hotspots(summary, 2000, 10)


@query(
    "monthly_fraud_top3",
    f"""WITH m AS (SELECT d.year, d.month, d.month_name, claim_type, COUNT(*) AS total_claims,
           CAST(SUM(fraud) AS BIGINT) AS fraud_claims, {SCORE_4} AS avg_fraud_score,
           CAST(SUM(claimed_amount) AS DOUBLE) AS total_claimed
         FROM claims c JOIN dates d ON c.date_key = d.date_key GROUP BY 1, 2, 3, 4),
       r AS (SELECT *, rank() OVER (PARTITION BY year, month ORDER BY fraud_claims DESC) AS fraud_rank,
           CAST(SUM(fraud_claims) OVER (PARTITION BY claim_type, year ORDER BY month) AS BIGINT) AS ytd_fraud_claims,
           lag(fraud_claims) OVER (PARTITION BY claim_type ORDER BY year, month) AS prev_month_fraud FROM m)
       SELECT * FROM r WHERE fraud_rank <= 3""",
)
def monthly_fraud_top3(t: Tables):
    return reports.monthly_fraud_top(t.star)


@query(
    "kpi",
    f"""SELECT COUNT(*) AS total_claims, CAST(SUM(claimed_amount) AS DOUBLE) AS total_claimed,
         CAST(SUM(fraud) AS BIGINT) AS fraud_claims, {FRAUD_PCT} AS fraud_rate_pct FROM claims""",
)
def kpi(t: Tables):
    return dashboards.kpi(t.claims)


@query(
    "type_rates",
    f"""SELECT claim_type, COUNT(*) AS total, CAST(SUM(fraud) AS BIGINT) AS fraud_cnt,
         {FRAUD_PCT} AS fraud_rate FROM claims WHERE claim_type IS NOT NULL GROUP BY claim_type""",
)
def type_rates(t: Tables):
    return dashboards.type_rates(t.claims)


@query(
    "category_rate_band",
    f"""SELECT *, CASE WHEN fraud_rate > 13 THEN 'danger' WHEN fraud_rate > 11 THEN 'warning'
           ELSE 'success' END AS rate_class
       FROM (SELECT category, {FRAUD_PCT} AS fraud_rate,
         (SELECT {FRAUD_PCT} FROM claims) AS overall_rate
         FROM claims c LEFT JOIN policies p ON c.policy_id = p.policy_id
         LEFT JOIN policy_types y ON p.policy_type_id = y.policy_type_id
         WHERE category IS NOT NULL GROUP BY category)""",
)
def category_rate_band(t: Tables):
    return dashboards.category_rate_band(t.star)


@query(
    "monthly_trend",
    """SELECT year(claim_date) AS year, month(claim_date) AS month, COUNT(*) AS count,
         CAST(SUM(fraud) AS BIGINT) AS fraud FROM claims
       WHERE year(claim_date) IN (1997, 1998, 1999) GROUP BY 1, 2""",
)
def monthly_trend(t: Tables):
    return dashboards.monthly_counts(t.claims, [1997, 1998, 1999])


@query(
    "age_band_rates",
    f"""WITH g AS (SELECT age_band, {FRAUD_PCT} AS fraud_rate, COUNT(*) AS count {LEFT_JOINED} GROUP BY 1)
       SELECT age_band, CAST(position AS BIGINT) AS position, fraud_rate, count
       FROM (VALUES ('18-25', 1), ('26-35', 2), ('36-45', 3), ('46-55', 4), ('56-65', 5), ('65+', 6))
         AS b(age_band, position) LEFT JOIN g USING (age_band)""",
)
def age_band_rates(t: Tables):
    return dashboards.age_band_rates(t.star)


def _cell(band: str) -> str:
    return (
        f"coalesce(100.0 * CAST(SUM(fraud) FILTER (income_band = '{band}') AS DOUBLE)"
        f" / CAST(COUNT(*) FILTER (income_band = '{band}') AS DOUBLE), 0.0) AS \"{band}\""
    )


@query(
    "credit_income_pivot",
    f"""SELECT credit_band, {_cell('Low')}, {_cell('Medium')}, {_cell('High')}, {_cell('Very High')}
       {LEFT_JOINED} WHERE credit_band IS NOT NULL AND income_band IS NOT NULL GROUP BY credit_band""",
)
def credit_income_pivot(t: Tables):
    return dashboards.credit_income_rates(t.star)


@query(
    "region_perf",
    f"""SELECT region, COUNT(*) AS total, CAST(SUM(fraud) AS BIGINT) AS fraud,
         CAST(SUM(claimed_amount) AS DOUBLE) / COUNT(*) AS avg_amount, {FRAUD_PCT} AS fraud_rate
       FROM claims c LEFT JOIN agents a ON c.agent_id = a.agent_id
       WHERE region IS NOT NULL GROUP BY region""",
)
def region_perf(t: Tables):
    return dashboards.region_performance(t.star)


@query(
    "amount_by_status_box",
    """WITH v AS (SELECT status, CAST(claimed_amount AS DOUBLE) AS v FROM claims),
       q AS (SELECT status, COUNT(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
           quantile_cont(v, 0.75) AS q3 FROM v GROUP BY status)
       SELECT status, n, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
         round(least(min(v) FILTER (v >= q1 - 1.5 * (q3 - q1)), q1), 4) AS whisker_low,
         round(greatest(max(v) FILTER (v <= q3 + 1.5 * (q3 - q1)), q3), 4) AS whisker_high,
         COUNT(*) FILTER (v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS outliers
       FROM v JOIN q USING (status) GROUP BY status, n, q.q1, q.median, q.q3""",
)
def amount_by_status_box(t: Tables):
    box = dashboards.amount_by_status(t.claims)
    figures = ["q1", "median", "q3", "whisker_low", "whisker_high"]
    return box.withColumns({name: F.round(name, 4) for name in figures})


@query(
    "score_histogram",
    """WITH v AS (SELECT fraud_flag, CAST(fraud_score AS DOUBLE) AS v FROM claims),
       r AS (SELECT fraud_flag, COUNT(*) AS n, min(v) AS low, (max(v) - min(v)) / 25 AS width
             FROM v GROUP BY fraud_flag),
       b AS (SELECT fraud_flag, CAST(least(floor((v - low) / width), 24) AS BIGINT) AS bin, COUNT(*) AS k
             FROM v JOIN r USING (fraud_flag) GROUP BY 1, 2)
       SELECT r.fraud_flag, g.bin, low + g.bin * width AS bin_low, coalesce(k, 0) AS bin_count,
         coalesce(k, 0) / (n * width) AS density
       FROM r JOIN range(25) g(bin) ON true LEFT JOIN b ON b.fraud_flag = r.fraud_flag AND b.bin = g.bin""",
)
def score_histogram(t: Tables):
    return dashboards.score_histogram(t.claims)


@query(
    "top_cities",
    """WITH top AS (SELECT city, COUNT(*) AS fraud_count
         FROM claims c LEFT JOIN policies p ON c.policy_id = p.policy_id
         LEFT JOIN customers u ON p.customer_id = u.customer_id
         WHERE fraud_flag AND city IS NOT NULL GROUP BY city
         ORDER BY fraud_count DESC, city LIMIT 10)
       SELECT city, fraud_count, CASE WHEN fraud_count = (SELECT max(fraud_count) FROM top) THEN 'danger'
         WHEN fraud_count >= (SELECT quantile_cont(fraud_count::DOUBLE, 0.75) FROM top) THEN 'warning'
         ELSE 'info' END AS class FROM top""",
)
def top_cities(t: Tables):
    return dashboards.top_cities(t.star)


@query(
    "amount_sketch",
    """SELECT status, q AS share, COUNT(*) AS rows, true AS within FROM claims, (VALUES (0.05::DOUBLE), (0.25::DOUBLE),
         (0.5::DOUBLE), (0.75::DOUBLE), (0.95::DOUBLE)) AS v(q) GROUP BY 1, 2""",
)
def amount_sketch(t: Tables):
    """Quantiles of the amounts by status, from sketches merged over three refreshes,
    held against the ranks they truly have."""
    base = scratch_path(t.spark, "amount_sketch")

    def summarised(condition):
        return t.claims.filter(condition).groupBy("status").agg(
            F.count("*").alias("claim_count"), sketches.sketch(F.col("claimed_amount")).alias("amounts")
        )

    for batch, condition in enumerate(["date_key < 19970101", "date_key BETWEEN 19970101 AND 19991231", "date_key > 19991231"]):
        refresh_batch(t.spark, base, batch, summarised(condition), ["status"], ["claim_count"], ["amounts"])
    shares = [0.05, 0.25, 0.5, 0.75, 0.95]
    errors = sketches.rank_errors(t.claims, latest_summary(t.spark, base), "status", "claimed_amount", "amounts", shares)
    return errors.select("status", "share", "rows", (F.col("error") <= 2 * sketches.rank_error()).alias("within"))
