"""Upserts, history, time travel, quality, governance and agent chains."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkclaims.bindings.registry import query
from sparkclaims.bindings.tables import Tables
from sparkclaims.functions.risk import payout_ratio
from sparkclaims.operators import governance, history, quality, versions
from sparkclaims.operators.merge import initial_history
from sparkclaims.operators.merge import merge_scd1 as upsert
from sparkclaims.operators.merge import merge_scd2 as add_history
from sparkclaims.operators.membership import MembershipFilter, buckets_for, repeats_across_loads
from sparkclaims.operators.paths import closure, count_paths, expand_paths, list_paths, listing_tables
from sparkclaims.operators.timetravel import VersionedTable
from sparkclaims.schemas import DOUBLE, STRING, table
from sparkclaims.storage import materialize, scratch_path


@query(
    "merge_scd1",
    """WITH source AS (SELECT policy_id + CASE WHEN start_date >= DATE '2001-01-01' THEN 1000000000 ELSE 0 END AS policy_id,
           premium_amount, coverage_amount,
           CASE WHEN status = 'P' THEN 'X' WHEN status = 'O' THEN status END AS status FROM policies)
       SELECT coalesce(t.policy_id, s.policy_id) AS policy_id,
         CASE WHEN t.policy_id IS NULL THEN s.premium_amount ELSE t.premium_amount END::DOUBLE AS premium_amount,
         CASE WHEN t.policy_id IS NULL THEN s.coverage_amount ELSE t.coverage_amount END::DOUBLE AS coverage_amount,
         CASE WHEN t.policy_id IS NULL OR t.status <> s.status THEN s.status ELSE t.status END AS policy_status,
         CASE WHEN t.policy_id IS NULL OR t.status <> s.status THEN '2024-06-30' ELSE '2020-01-01' END AS load_date,
         customer_id
       FROM policies t FULL JOIN source s ON t.policy_id = s.policy_id""",
)
def merge_scd1(t: Tables):
    """Every policy arrives again: P became X, the status of F is unknown, and
    those from 2001 on carry a new key."""
    status, key = F.col("status"), F.col("policy_id")
    renewed = F.col("start_date") >= datetime.date(2001, 1, 1)
    source = t.policies.select(
        (key + F.when(renewed, 1000000000).otherwise(0)).alias("policy_id"),
        "premium_amount",
        "coverage_amount",
        F.when(status == "P", "X").when(status == "O", status).alias("status"),
    )
    target = t.policies.select(
        "policy_id", "premium_amount", "coverage_amount", F.col("status").alias("policy_status"),
        F.lit(datetime.date(2020, 1, 1)).alias("load_date"), "customer_id",
    )
    inserted = {
        "premium_amount": "premium_amount",
        "coverage_amount": "coverage_amount",
        "policy_status": "status",
    }
    stamp = {"load_date": F.lit(datetime.date(2024, 6, 30))}
    return upsert(target, source, ["policy_id"], ("policy_status", "status"), inserted, stamp)


@query(
    "merge_scd2",
    """SELECT customer_id, city, income_band, '2023-01-01' AS eff_start_date,
         CASE WHEN credit_band = 'Poor' THEN '2024-06-29' ELSE '9999-12-31' END AS eff_end_date,
         credit_band <> 'Poor' AS is_current FROM customers WHERE annual_income >= 0
       UNION ALL SELECT customer_id, CASE WHEN credit_band = 'Poor' THEN 'Moved' ELSE city END, income_band,
         '2024-06-30', '9999-12-31', true FROM customers WHERE credit_band = 'Poor' OR annual_income < 0""",
)
def merge_scd2(t: Tables):
    """Customers of poor credit moved; those of negative income are new."""
    rows = t.customers.select("customer_id", "city", "income_band")
    known = t.customers.filter("annual_income >= 0").select(*rows.columns)
    moved = F.when(F.col("credit_band") == "Poor", "Moved").otherwise(F.col("city"))
    source = t.customers.withColumn("city", moved).select(*rows.columns)
    merged = add_history(
        initial_history(known, datetime.date(2023, 1, 1)),
        source, ["customer_id"], ["city", "income_band"], datetime.date(2024, 6, 30),
    )
    return merged.drop("last_updated")


@query(
    "history_out_of_order",
    """WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, arg_max(event_type, event_id) AS kind, max(event_id) AS change_no
           FROM events GROUP BY 1, 2),
         c AS (SELECT *, lag(kind) OVER (PARTITION BY user_id ORDER BY day) AS old FROM d),
         n AS (SELECT *, lead(day) OVER (PARTITION BY user_id ORDER BY day) AS next FROM c WHERE old IS DISTINCT FROM kind)
       SELECT user_id, kind, change_no, CAST(day AS VARCHAR) AS eff_start_date,
         coalesce(CAST(next - 1 AS VARCHAR), '9999-12-31') AS eff_end_date, next IS NULL AS is_current
       FROM n WHERE kind <> 'error'""",
)
def history_out_of_order(t: Tables):
    """The last event of a user and day is a change, an error ends the user's
    period. They come in three loads with old and new days mixed."""
    changes = t.raw("events").select(
        "user_id", F.col("ts").cast("date").alias("day"), F.col("event_id").alias("change_no"), F.col("event_type").alias("kind")
    )
    keys, order, gone = ["user_id"], ["change_no"], F.col("kind") == "error"

    def part(number: int):
        return changes.filter(F.col("change_no") % 3 == number)

    events = materialize(history.add_changes(changes.limit(0), part(2), keys, "day", order), "events")
    drawn = history.periods(events, keys, "day", ["kind"], gone)
    for number in (0, 1):
        events, drawn = history.apply_changes(events, drawn, part(number), keys, "day", order, ["kind"], gone)
    return drawn.drop("day")


UNTIL = "2024-01-15 09:00:00"
_VERSION = ["ts", "event_id"]


def _log(t: Tables):
    return t.raw("events").select("user_id", "event_id", "ts", "event_type", "value")


_AS_OF_SQL = """SELECT * FROM (SELECT user_id, event_id, event_type, value,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n
       FROM events WHERE {until}) WHERE n = 1 AND event_type <> 'error'"""


def _as_of(until: str) -> str:
    return f"SELECT user_id, event_id, event_type, value FROM ({_AS_OF_SQL.format(until=until)})"


@query("as_of_read", _as_of(f"ts <= TIMESTAMP '{UNTIL}'"))
def as_of_read(t: Tables):
    """The table of users as of a moment; an error removes the user."""
    until = F.col("ts") <= F.lit(UNTIL).cast("timestamp_ntz")
    deleted = F.col("event_type") == "error"
    return versions.as_of(_log(t), ["user_id"], _VERSION, until, deleted).drop("ts")


@query("as_of_count", f"SELECT COUNT(*) AS rows FROM ({_as_of('ts <= (SELECT max(ts) FROM events) - INTERVAL 3600 SECOND')})")
def as_of_count(t: Tables):
    """Rows one hour before the last change."""
    log = _log(t)
    until = versions.offset_bound("ts", log.agg(F.max("ts")).scalar(), -3600)
    deleted = F.col("event_type") == "error"
    return versions.as_of(log, ["user_id"], _VERSION, until, deleted).agg(F.count("*").alias("rows"))


@query("restore_before", _as_of("event_id < (SELECT max(event_id) FROM events)"))
def restore_before(t: Tables):
    """The table of users without the last change."""
    log = _log(t)
    last = log.agg(F.max("event_id")).scalar()
    deleted = F.col("event_type") == "error"
    return versions.before_statement(log, ["user_id"], _VERSION, "event_id", last, deleted).drop("ts")


# Days on which the changes of the users are committed, up to the day before.
_COMMITS = [datetime.datetime(2024, 1, day) for day in (6, 11, 16, 21, 26)]
USERS = table(user_id=T.LongType(), event_id=T.LongType(), event_type=STRING, value=DOUBLE)


def _committed(t: Tables) -> VersionedTable:
    """Five commits of the users' last events, with a base after the third."""
    users = VersionedTable(scratch_path(t.spark, "users"), USERS, ("user_id",))
    log = _log(t)
    for number, day in enumerate(_COMMITS):
        since = F.lit(_COMMITS[number - 1]).cast("timestamp_ntz") if number else F.lit("2000-01-01").cast("timestamp_ntz")
        until = (F.col("ts") >= since) & (F.col("ts") < F.lit(day).cast("timestamp_ntz"))
        changes = versions.as_of(log, ["user_id"], _VERSION, until).withColumn("deleted", F.col("event_type") == "error")
        users.commit(changes, day, f"load {number}")
        if number == 2:
            users.checkpoint(t.spark)
    return users


@query("time_travel_at", _as_of("ts < TIMESTAMP '2024-01-21'"))
def time_travel_at(t: Tables):
    """The users as of noon on 23 January: the base of the third commit and the fourth."""
    users = _committed(t)
    return users.read(t.spark, users.version_at(t.spark, datetime.datetime(2024, 1, 23, 12)))


@query("time_travel_before", _as_of("ts < TIMESTAMP '2024-01-11'"))
def time_travel_before(t: Tables):
    """A restore of the users as they were before the third load, read from a clone of the table."""
    users = _committed(t)
    before = users.version_before(t.spark, "load 2")
    users.restore(t.spark, before, datetime.datetime(2024, 2, 1))
    return users.clone(t.spark, scratch_path(t.spark, "users-clone"), datetime.datetime(2024, 2, 2)).read(t.spark)


@query(
    "clone_snapshot",
    """SELECT 'clone' AS source, COUNT(*) AS rows, CAST(SUM(premium_amount) AS DOUBLE) AS premium FROM policies
       UNION ALL SELECT 'original', COUNT(*), CAST(SUM(premium_amount) AS DOUBLE) FROM policies WHERE status <> 'F'""",
)
def clone_snapshot(t: Tables):
    """The clone keeps its rows after the original moves on."""
    base = scratch_path(t.spark, "snapshots")
    rows = t.policies.select("policy_id", "premium_amount", "status")
    versions.write_snapshot(rows, base, 1)
    clone = versions.read_snapshot(t.spark, base, 1)
    versions.write_snapshot(clone.filter("status <> 'F'"), base, 2)
    both = clone.withColumn("source", F.lit("clone")).unionByName(
        versions.read_snapshot(t.spark, base, 2).withColumn("source", F.lit("original"))
    )
    return both.groupBy("source").agg(F.count("*").alias("rows"), F.sum("premium_amount").alias("premium"))


@query(
    "dq_report",
    """WITH k AS (SELECT *, CASE WHEN status <> 'Rejected' THEN policy_id END AS key_1 FROM claims),
       d AS (SELECT SUM(n - 1) AS duplicates FROM (SELECT COUNT(*) AS n FROM k GROUP BY key_1, line_no))
       SELECT 'fact_claims' AS table_name, COUNT(*) AS total_rows,
         CAST(COUNT(*) FILTER (key_1 IS NULL) AS DOUBLE) / COUNT(*) AS null_pct_policy_id,
         0.0::DOUBLE AS null_pct_line_no, CAST((SELECT duplicates FROM d) AS BIGINT) AS duplicates,
         COUNT(*) FILTER (fraud_score > 1 OR fraud_score < 0) AS fraud_score_out_of_range,
         COUNT(*) FILTER (approved_amount < 0) AS negative_payout_ratio,
         CAST(CASE WHEN count(*) FILTER (key_1 IS NULL) > 0.05 * count(*) THEN 1 ELSE 0 END
           + CASE WHEN (SELECT duplicates FROM d) > 0 THEN 1 ELSE 0 END AS BIGINT) AS issue_count,
         false AS passed
       FROM k""",
)
def dq_report(t: Tables):
    """Claims whose key is neither complete nor unique."""
    key = F.when(F.col("status") != "Rejected", F.col("policy_id"))
    ratio = payout_ratio(F.col("approved_amount"), F.col("claimed_amount"))
    rows = t.claims.select(key.alias("policy_id"), "line_no", "fraud_score", ratio.alias("payout_ratio"))
    report = quality.quality_report(rows, "fact_claims", ["policy_id", "line_no"])
    return report.withColumn("issue_count", F.size("issues")).drop("issues")


@query(
    "dq_duplicates",
    """SELECT CAST(SUM(n - 1) AS BIGINT) AS duplicates
       FROM (SELECT COUNT(*) AS n FROM claims GROUP BY policy_id, line_no)""",
)
def dq_duplicates(t: Tables):
    return quality.duplicate_count(t.claims, ["policy_id", "line_no"])


@query(
    "dq_across_loads",
    """WITH old AS (SELECT DISTINCT policy_id, line_no FROM claims WHERE claim_date < DATE '1999-01-01'),
         new AS (SELECT policy_id, line_no FROM claims WHERE claim_date >= DATE '1999-01-01' OR agent_id % 7 = 0)
       SELECT policy_id, CAST(line_no AS BIGINT) AS line_no, COUNT(*) AS rows,
         (SELECT COUNT(*) FROM claims c WHERE claim_date < DATE '1999-01-01' AND c.policy_id = n.policy_id AND c.line_no = n.line_no) AS rows_loaded
       FROM new n SEMI JOIN old USING (policy_id, line_no) GROUP BY policy_id, line_no""",
)
def dq_across_loads(t: Tables):
    """Claims from 1999 on, and some earlier ones again, held against the claims before 1999."""
    early = F.col("claim_date") < datetime.date(1999, 1, 1)
    keys = ["policy_id", "line_no"]
    loaded = t.claims.filter(early).select(*keys)
    known = MembershipFilter(scratch_path(t.spark, "loaded"), tuple(keys), buckets_for(loaded.count()))
    for year in ("claim_date < DATE '1997-01-01'", "claim_date >= DATE '1997-01-01'"):
        known.add(t.claims.filter(early).filter(year).select(*keys))
    incoming = t.claims.filter(~early | (F.col("agent_id") % 7 == 0)).select(*keys)
    return repeats_across_loads(incoming, loaded, known)


@query(
    "data_dictionary",
    """SELECT 'dwh' AS table_schema, 'dim_customers' AS table_name, column_name, data_type, description, pii_flag,
         (SELECT COUNT(*) FROM customers) AS total_rows, null_rows
       FROM (SELECT UNNEST([
         {'column_name': 'customer_id', 'data_type': 'bigint', 'description': NULL, 'pii_flag': false, 'null_rows': 0},
         {'column_name': 'age', 'data_type': 'int', 'description': NULL, 'pii_flag': false, 'null_rows': 0},
         {'column_name': 'annual_income', 'data_type': 'decimal(15,2)',
          'description': 'Customer declared annual income', 'pii_flag': true, 'null_rows': 0},
         {'column_name': 'income_band', 'data_type': 'string', 'description': NULL, 'pii_flag': false,
          'null_rows': (SELECT COUNT(*) FROM customers WHERE income_band IS NULL)},
         {'column_name': 'credit_score', 'data_type': 'int', 'description': 'Credit bureau score 300–850',
          'pii_flag': true, 'null_rows': 0},
         {'column_name': 'full_name', 'data_type': 'string', 'description': NULL, 'pii_flag': false,
          'null_rows': (SELECT COUNT(*) FROM customers WHERE full_name IS NULL)}], recursive := true))
       UNION ALL
       SELECT 'dwh', 'fact_claims', column_name, data_type, description, false, (SELECT COUNT(*) FROM claims), 0
       FROM (VALUES ('claim_id', 'string', NULL), ('fraud_flag', 'boolean', 'Manual/model fraud label'),
         ('fraud_score', 'decimal(6,4)', 'ML model score (0=clean, 1=fraud)')) AS v(column_name, data_type, description)""",
)
def data_dictionary(t: Tables):
    """Types, annotations and completeness of two tables."""
    tables = {
        "dim_customers": t.customers.select(
            "customer_id", "age", "annual_income", "income_band", "credit_score", "full_name"
        ),
        "fact_claims": t.claims.select("claim_id", "fraud_flag", "fraud_score"),
    }
    profiles = [quality.null_profile(df, name) for name, df in tables.items()]
    return governance.data_dictionary(tables).join(
        profiles[0].unionByName(profiles[1]), ["table_name", "column_name"]
    )


@query(
    "mask_customers",
    """SELECT customer_id, annual_income::DOUBLE AS annual_income, CAST(0 AS BIGINT) AS credit_score, 'CLAIMS_MANAGER_ROLE' AS role
         FROM customers
       UNION ALL SELECT customer_id, -1.0, credit_score, 'DATA_STEWARD_ROLE' FROM customers
       UNION ALL SELECT customer_id, annual_income::DOUBLE, credit_score, 'SYSADMIN' FROM customers
       UNION ALL SELECT customer_id, -1.0, 0, 'ANALYST_ROLE' FROM customers""",
)
def mask_customers(t: Tables):
    rows = t.customers.select("customer_id", "annual_income", "credit_score")
    seen = [
        governance.mask(rows, governance.CUSTOMER_MASKS, role).withColumn("role", F.lit(role))
        for role in (governance.MANAGER, governance.STEWARD, governance.ADMIN, governance.ANALYST)
    ]
    return seen[0].unionByName(seen[1]).unionByName(seen[2]).unionByName(seen[3])


@query(
    "region_rows",
    """SELECT 'ASIA' AS session_user, region, COUNT(*) AS claims, CAST(SUM(claimed_amount) AS DOUBLE) AS claimed
         FROM claims c JOIN agents a ON c.agent_id = a.agent_id WHERE region = 'ASIA' GROUP BY 2
       UNION ALL SELECT u, region, COUNT(*), CAST(SUM(claimed_amount) AS DOUBLE)
         FROM claims c JOIN agents a ON c.agent_id = a.agent_id, (VALUES ('MANAGER'), ('STEWARD'), ('ADMIN')) v(u) GROUP BY 1, 2""",
)
def region_rows(t: Tables):
    """Claims of the agents that an analyst for Asia, and those above, may see.

    The roles of a session follow from the grants: a steward's session holds
    the steward role, an analyst's does not. The claims are summed per agent
    once, for all sessions.
    """
    grants = t.spark.createDataFrame(governance.ROLE_GRANTS, "role string, granted_to string")
    held = closure(grants, "role", "granted_to")

    def seen(role: str, user: str):
        roles = governance.session_roles(held, role)
        agents = governance.region_filter(t.agents, "region", role, user, roles)
        return agents.select("agent_id", "region", F.lit(user).alias("session_user"))

    per_agent = t.claims.groupBy("agent_id").agg(
        F.count("*").alias("claims"), F.sum("claimed_amount").alias("claimed")
    )
    return (
        seen(governance.ANALYST, "ASIA")
        .unionByName(seen(governance.STEWARD, "STEWARD"))
        .unionByName(seen(governance.MANAGER, "MANAGER"))
        .unionByName(seen(governance.ADMIN, "ADMIN"))
        .join(per_agent, "agent_id")
        .groupBy("session_user", "region")
        .agg(F.sum("claims").alias("claims"), F.sum("claimed").alias("claimed"))
    )


@query(
    "role_closure",
    """WITH RECURSIVE held AS (
         SELECT n_name AS holder, n_name AS held FROM nation
         UNION SELECT r_name, r_name FROM region UNION SELECT 'WORLD', 'WORLD'
         UNION SELECT e.holder, h.held FROM held h JOIN (
           SELECT r_name AS holder, n_name AS via FROM nation JOIN region ON n_regionkey = r_regionkey
           UNION ALL SELECT 'WORLD', r_name FROM region) e ON h.holder = e.via)
       SELECT holder AS role, COUNT(DISTINCT held) AS roles_held, COUNT(agent_id) AS agents
       FROM held LEFT JOIN agents a ON a.nation = held GROUP BY holder""",
)
def role_closure(t: Tables):
    """Agents in reach of a role per nation, granted to its region and to the world."""
    places = t.raw("nation").join(
        t.raw("region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    edges = places.select(F.col("n_name").alias("role"), F.col("r_name").alias("granted_to")).unionByName(
        places.select(F.col("r_name").alias("role"), F.lit("WORLD").alias("granted_to"))
    )
    per_nation = t.agents.groupBy(F.col("nation").alias("held")).agg(F.count("*").alias("_agents"))
    return (
        closure(edges, "role", "granted_to")
        .join(per_nation, "held", "left")
        .groupBy(F.col("holder").alias("role"))
        .agg(
            F.count("*").alias("roles_held"),
            F.coalesce(F.sum("_agents"), F.lit(0)).alias("agents"),
        )
    )


_AGENT_COLUMNS = ["agent_id", "agent_name", "nation"]


@query(
    "agent_paths",
    """WITH RECURSIVE chain AS (
         SELECT agent_id, agent_name, nation, CAST(1 AS BIGINT) AS level, CAST(agent_id AS VARCHAR) AS path
         FROM agents WHERE experience_years > 17
         UNION ALL
         SELECT a.agent_id, a.agent_name, a.nation, h.level + 1, h.path || ' -> ' || a.agent_id
         FROM agents a JOIN chain h ON a.nation = h.nation AND a.agent_id <> h.agent_id
         WHERE h.level < 3)
       SELECT DISTINCT agent_id, agent_name, nation, level, path FROM chain""",
)
def agent_paths(t: Tables):
    """Chains within a nation: every path is a row, so the result is cubic in the
    agents of a nation. ``count_paths`` counts them for larger groups."""
    experts = t.agents.filter("experience_years > 17").select(*_AGENT_COLUMNS)
    return expand_paths(t.agents.select(*_AGENT_COLUMNS), experts, "agent_id", "nation")


@query(
    "agent_path_counts",
    """WITH RECURSIVE chain AS (
         SELECT agent_id, region, CAST(1 AS BIGINT) AS level FROM agents WHERE experience_years > 17
         UNION ALL
         SELECT a.agent_id, a.region, h.level + 1
         FROM agents a JOIN chain h ON a.region = h.region AND a.agent_id <> h.agent_id
         WHERE h.level < 3)
       SELECT agent_id, region, level, CAST(COUNT(*) AS DOUBLE) AS paths FROM chain GROUP BY 1, 2, 3""",
)
def agent_path_counts(t: Tables):
    """The chains within whole regions, counted without listing them."""
    rows = t.agents.select("agent_id", "region", "experience_years")
    return count_paths(rows, F.col("experience_years") > 17, "agent_id", "region").drop("experience_years")


@query(
    "agent_path_listing",
    """WITH RECURSIVE chain AS (
         SELECT agent_id, region, CAST(1 AS BIGINT) AS level, CAST(agent_id AS VARCHAR) AS path, [agent_id] AS members
         FROM agents WHERE experience_years > 17
         UNION ALL
         SELECT a.agent_id, a.region, h.level + 1, h.path || ' -> ' || a.agent_id, list_append(h.members, a.agent_id)
         FROM agents a JOIN chain h ON a.region = h.region AND a.agent_id <> h.agent_id
         WHERE h.level < 3)
       SELECT row_number() OVER (ORDER BY region, level, members) - 1 AS rank, agent_id, region, level, path FROM chain""",
)
def agent_path_listing(t: Tables):
    """The chains within whole regions in three slices of the sorted listing, each made by itself."""
    rows, in_base = t.agents.select("agent_id", "region", "experience_years"), F.col("experience_years") > 17

    listing = listing_tables(rows, in_base, "agent_id", "region")

    def part(start, stop):
        return list_paths(rows, in_base, "agent_id", "region", start, stop, listing=listing)

    return part(0, 100).unionByName(part(100, 1_000)).unionByName(part(1_000, None))
