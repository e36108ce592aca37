"""Independent DuckDB SQL for every query, computed straight from the driver tables.

The oracle never builds or parses JSON: the change-event round trip is an
identity, so expected rows come from the FIXTURES.md mapping applied to the
source columns. Money is handled in integer cents.
"""

from __future__ import annotations

from bankflow import schemas as S

AS1 = "TIMESTAMP '2024-01-02 00:00:00'"
AS2 = "TIMESTAMP '2024-01-03 00:00:00'"
AS3 = "TIMESTAMP '2024-01-04 00:00:00'"
DAY1_MS = 1704067200000
DAY2_MS = 1704153600000


def money(cents: str, scale_type: str = "DECIMAL(18,2)") -> str:
    """Exact money from integer cents."""
    return f"CAST(CAST({cents} AS DECIMAL(38,0)) * 0.01 AS {scale_type})"


def money_text(cents: str) -> str:
    """'12.50' from 1250 (non-negative cents)."""
    return f"(CAST(({cents}) // 100 AS VARCHAR) || '.' || lpad(CAST(({cents}) % 100 AS VARCHAR), 2, '0'))"


def capitalize(x: str) -> str:
    return f"(upper(substr({x}, 1, 1)) || lower(substr({x}, 2)))"


# ---------------------------------------------------------------- shared CTEs (name -> body)
CTE: dict[str, str] = {}
CTE["prm"] = """SELECT (SELECT max(c_custkey) FROM customer) + 1 AS n,
       (SELECT max(c_custkey) FROM customer) + 1 - ((SELECT max(c_custkey) FROM customer) + 1) // 10 AS cutoff,
       (SELECT max(user_id) FROM events) + 1 AS m"""
CTE["cust0"] = """SELECT c.c_custkey AS k,
       split_part(c.c_name, '#', 1) AS first_name,
       split_part(c.c_name, '#', 2) AS last_name,
       lower(split_part(c.c_name, '#', 1)) || '.' || split_part(c.c_name, '#', 2) || '@example.com' AS email,
       CASE WHEN c.c_custkey % 13 = 0 THEN NULL
            ELSE '555-' || lpad(CAST(c.c_custkey % 10000 AS VARCHAR), 4, '0') END AS phone,
       CASE WHEN c.c_custkey % 2 = 0 THEN DATE '1970-01-01' + CAST(c.c_custkey % 10000 AS INTEGER) END AS date_of_birth,
       CASE WHEN n.n_nationkey IS NULL THEN NULL ELSE concat_ws(', ', n.n_name, r.r_name) END AS address,
       CASE c.c_mktsegment WHEN 'MACHINERY' THEN 'INACTIVE' WHEN 'FURNITURE' THEN 'SUSPENDED' ELSE 'ACTIVE' END AS status,
       CASE WHEN c.c_custkey % 97 = 0 THEN NULL
            ELSE TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c.c_custkey) END AS created_at
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""
# state after the day-2 changes (missing keys included: the change log keeps them)
CTE["cust_log"] = """SELECT k, first_name, last_name, email,
       CASE WHEN k < cutoff AND k % 10 = 0 THEN '555-9999' ELSE phone END AS phone,
       CASE WHEN k < cutoff AND k % 10 = 5 THEN DATE '2000-01-01' ELSE date_of_birth END AS date_of_birth,
       address, status, created_at
FROM cust0, prm"""
CTE["cust1"] = "SELECT cust0.* FROM cust0, prm WHERE k < cutoff"
CTE["cust2"] = "SELECT cust_log.* FROM cust_log, prm WHERE NOT (k < cutoff AND k % 10 = 7)"
CTE["acct"] = """SELECT c.c_custkey * 2 + u.u AS id, c.c_custkey AS k,
       CASE (c.c_custkey * 2 + u.u) % 3 WHEN 0 THEN 'SAVINGS' WHEN 1 THEN 'CHECKING' ELSE 'CREDIT' END AS account_type,
       CASE WHEN (c.c_custkey * 2 + u.u) % 17 = 0 THEN 'CLOSED'
            WHEN (c.c_custkey * 2 + u.u) % 19 = 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status,
       CAST(round(abs(c.c_acctbal) * 100) AS BIGINT) // (4 * (u.u + 1)) AS cents1,
       CAST(round(abs(c.c_acctbal) * 100) AS BIGINT) // (4 * (u.u + 1))
         + CASE WHEN (c.c_custkey * 2 + u.u) % 6 = 0 THEN 10000 ELSE 0 END AS cents2,
       TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c.c_custkey) AS created_at
FROM customer c CROSS JOIN (VALUES (0), (1)) AS u(u)"""
CTE["txn"] = """SELECT ev.event_id AS e, ev.event_id + 1 AS id, ev.user_id * 2 + ev.event_id % 2 AS account_id,
       CASE ev.event_type WHEN 'purchase' THEN 'WITHDRAWAL' WHEN 'click' THEN 'TRANSFER' ELSE 'DEPOSIT' END AS txn_type,
       CASE WHEN ev.event_type = 'click'
            THEN ((ev.user_id + 1 + ev.event_id % 7) % prm.m) * 2 + (ev.event_id // 2) % 2 END AS related_account_id,
       CAST(round(ev.value * 1000) AS BIGINT) AS cents,
       CASE WHEN ev.event_type = 'error' THEN 'FAILED' WHEN ev.event_id % 101 = 0 THEN 'REVERSED'
            WHEN ev.event_id % 103 = 0 THEN 'PENDING' ELSE 'COMPLETED' END AS status,
       'EVT-' || CAST(ev.event_id AS VARCHAR) AS reference,
       ev.ts AS created_at
FROM events ev, prm"""
CTE["txn_x"] = f"""SELECT txn.*, CASE WHEN txn_type = 'DEPOSIT' THEN 'CREDIT' ELSE 'DEBIT' END AS direction,
       {capitalize('txn_type')} || ' of ' || {money_text('cents')} || ' USD' AS txn_desc
FROM txn"""
CTE["led"] = """SELECT 2 * id AS id, id AS transaction_id, account_id,
       CASE WHEN txn_type = 'DEPOSIT' THEN 'DEBIT' ELSE 'CREDIT' END AS entry_type, cents, created_at FROM txn
UNION ALL
SELECT 2 * id + 1, id, CASE WHEN txn_type = 'TRANSFER' THEN related_account_id END,
       CASE WHEN txn_type = 'DEPOSIT' THEN 'CREDIT' ELSE 'DEBIT' END, cents, created_at FROM txn"""
# the change log (CDC events) at row level
CTE["log"] = f"""SELECT 'customers' AS table_name, 'c' AS op, 4 * k AS seq, {DAY1_MS} + k * 1000 AS ts_ms,
       k AS row_id, CAST(TIMESTAMP '2024-01-01' AS DATE) AS day FROM cust0, prm WHERE k < cutoff
UNION ALL SELECT 'customers', CASE WHEN k >= cutoff THEN 'c' ELSE 'u' END, 4 * k + 1, {DAY2_MS} + k * 1000, k,
       DATE '2024-01-02' FROM cust0, prm WHERE k >= cutoff OR k % 10 IN (0, 5)
UNION ALL SELECT 'customers', 'd', 4 * k + 1, {DAY2_MS} + k * 1000, k, DATE '2024-01-02'
       FROM cust0, prm WHERE k < cutoff AND k % 10 = 7
UNION ALL SELECT 'accounts', 'c', 2 * id, {DAY1_MS} + k * 1000, id, DATE '2024-01-01' FROM acct
UNION ALL SELECT 'accounts', 'u', 2 * id + 1, {DAY2_MS} + k * 1000, id, DATE '2024-01-02' FROM acct WHERE id % 6 = 0
UNION ALL SELECT 'transactions', 'c', 2 * id, epoch_us(created_at) // 1000, id, CAST(created_at AS DATE) FROM txn
UNION ALL SELECT 'transactions', 'u', 2 * id + 1, epoch_us(created_at) // 1000, id, CAST(created_at AS DATE) FROM txn
UNION ALL SELECT 'ledger_entries', 'c', id, epoch_us(created_at) // 1000, id, CAST(created_at AS DATE) FROM led"""
CTE["upserts"] = "SELECT * FROM log WHERE op <> 'd'"


def _stg_customers(src: str, load: str) -> str:
    return f"""SELECT CAST(k AS VARCHAR) AS customer_id, first_name, last_name, email, phone, date_of_birth,
       address AS cust_address, status AS cust_status, created_at, {load} AS load_timestamp FROM {src}"""


def _stg_accounts(cents: str, load: str) -> str:
    return f"""SELECT CAST(id AS VARCHAR) AS account_id, CAST(k AS VARCHAR) AS customer_id, account_type,
       status AS account_status, CAST({cents} AS DOUBLE) / 100 AS balance,
       CASE WHEN account_type = 'CHECKING' THEN NULL ELSE CAST(id % 5 AS DOUBLE) / 100 END AS interest_rate,
       'USD' AS currency, created_at, {load} AS load_timestamp FROM acct"""


BAL_AFTER = "rtrim(rtrim(" + money_text("cents + 100000") + ", '0'), '.')"


def _stg_txn(image: str, src: str = "txn_x") -> str:
    bal = "CAST(NULL AS VARCHAR)" if image == "c" else BAL_AFTER
    return f"""SELECT CAST(id AS VARCHAR) AS transaction_id, CAST(account_id AS VARCHAR) AS account_id,
       CAST(related_account_id AS VARCHAR) AS related_account_id, txn_type, direction,
       CAST(cents AS DOUBLE) / 100 AS amount, {bal} AS balance_after, status AS txn_status, reference,
       txn_desc, created_at AS txn_time, {AS2} AS load_timestamp, e FROM {src}"""


CTE["stg_cust_log"] = _stg_customers("cust_log", AS2)
CTE["stg_acct_log"] = _stg_accounts("cents2", AS2)
CTE["stg_txn"] = _stg_txn("u")
CTE["stg_txn_written"] = _stg_txn("c") + "\nUNION ALL\n" + _stg_txn("u")
CTE["stg_led"] = f"""SELECT CAST(id AS VARCHAR) AS id, CAST(transaction_id AS VARCHAR) AS transaction_id,
       CAST(account_id AS VARCHAR) AS account_id, entry_type, CAST(cents AS DOUBLE) / 100 AS amount,
       created_at AS txn_time, {AS2} AS load_timestamp FROM led"""
CTE["stg_cust1"] = _stg_customers("cust1", AS1)
CTE["stg_cust2"] = _stg_customers("cust2", AS2)
CTE["stg_acct1"] = _stg_accounts("cents1", AS1)
CTE["stg_acct2"] = _stg_accounts("cents2", AS2)

# posting requests, validation and the sequential fold
CTE["req"] = """SELECT id, e, CASE WHEN e % 211 = 5 THEN -1 ELSE account_id END AS account_id,
       CASE WHEN txn_type = 'TRANSFER' AND e % 223 = 7 THEN NULL ELSE related_account_id END AS related_account_id,
       txn_type, CASE WHEN e % 307 = 11 THEN 0 ELSE cents END AS cents, created_at, direction, status, reference
FROM txn_x"""
CTE["val"] = """SELECT r.*, CASE
       WHEN r.cents IS NULL OR r.cents <= 0 THEN 'AMOUNT_NOT_POSITIVE'
       WHEN r.txn_type = 'TRANSFER' AND r.related_account_id IS NULL THEN 'MISSING_DESTINATION'
       WHEN r.txn_type IS NULL OR r.txn_type NOT IN ('DEPOSIT', 'WITHDRAWAL', 'TRANSFER') THEN 'UNSUPPORTED_TYPE'
       WHEN a.id IS NULL THEN 'UNKNOWN_ACCOUNT'
       WHEN r.related_account_id IS NOT NULL AND d.id IS NULL THEN 'UNKNOWN_DESTINATION'
       WHEN r.txn_type IN ('WITHDRAWAL', 'TRANSFER') AND a.cents1 IS NULL THEN 'NULL_BALANCE'
     END AS reject_reason
FROM req r LEFT JOIN acct a ON r.account_id = a.id LEFT JOIN acct d ON r.related_account_id = d.id"""
# Legs of the statically valid requests: leg 0 on the request's account, leg 1
# on a transfer's destination. Deltas in cents.
CTE["vlegs"] = """SELECT id, account_id AS acct, 0 AS leg,
       CASE WHEN txn_type = 'DEPOSIT' THEN cents ELSE -cents END AS delta, txn_type <> 'DEPOSIT' AS is_debit, cents
FROM val WHERE reject_reason IS NULL
UNION ALL
SELECT id, related_account_id, 1, cents, FALSE, cents FROM val WHERE reject_reason IS NULL AND txn_type = 'TRANSFER'"""
# Jacobi relaxation of the sequential fold: start from "all accepted", recompute
# every decision from the previous guess, stop when nothing moves. A decision
# depends only on earlier ids (a triangular system), so this reaches the unique
# sequential answer.
CTE["jac(iter, id, acc)"] = """SELECT 0, id, TRUE FROM val WHERE reject_reason IS NULL
UNION ALL
SELECT iter, id, acc FROM (
  SELECT iter, id, acc, bool_or(acc IS DISTINCT FROM old) OVER () AS moved FROM (
    SELECT iter, id, old, CASE WHEN NOT is_debit THEN TRUE ELSE COALESCE(before >= cents, FALSE) END AS acc FROM (
      SELECT j.iter + 1 AS iter, l.id, l.leg, l.is_debit, l.cents, j.acc AS old,
             a.cents1 + COALESCE(sum(CASE WHEN j.acc THEN l.delta ELSE 0 END) OVER (
                 PARTITION BY l.acct ORDER BY l.id, l.leg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
               AS before
      FROM vlegs l JOIN jac j ON j.id = l.id JOIN acct a ON a.id = l.acct) b
    WHERE leg = 0) c) d
WHERE moved"""
CTE["decided"] = "SELECT id, acc FROM jac WHERE iter = (SELECT max(iter) FROM jac)"
CTE["after_legs"] = """SELECT l.id, l.leg, l.acct,
       a.cents1 + sum(CASE WHEN d.acc THEN l.delta ELSE 0 END) OVER (
           PARTITION BY l.acct ORDER BY l.id RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bal
FROM vlegs l JOIN decided d ON d.id = l.id JOIN acct a ON a.id = l.acct"""
CTE["dec"] = f"""SELECT v.id, v.account_id, v.related_account_id, v.txn_type, v.cents, v.created_at,
       v.reject_reason IS NULL AND COALESCE(f.acc, FALSE) AS accepted,
       COALESCE(v.reject_reason, CASE WHEN NOT f.acc THEN 'INSUFFICIENT_FUNDS' END) AS reject_reason,
       CASE WHEN v.reject_reason IS NULL AND f.acc THEN {money('b.bal')} END AS balance_after
FROM val v LEFT JOIN decided f ON f.id = v.id LEFT JOIN after_legs b ON b.id = v.id AND b.leg = 0"""
CTE["post_led"] = """SELECT 2 * id AS id, id AS transaction_id, account_id,
       CASE WHEN txn_type = 'DEPOSIT' THEN 'DEBIT' ELSE 'CREDIT' END AS entry_type, cents, created_at
FROM dec WHERE accepted
UNION ALL
SELECT 2 * id + 1, id, CASE WHEN txn_type = 'TRANSFER' THEN related_account_id END,
       CASE WHEN txn_type = 'DEPOSIT' THEN 'CREDIT' ELSE 'DEBIT' END, cents, created_at
FROM dec WHERE accepted"""
CTE["closing"] = f"""SELECT a.id AS account_id, {money('a.cents1 + COALESCE(n.net, 0)', 'DECIMAL(38,2)')} AS balance
FROM acct a LEFT JOIN (SELECT l.acct, sum(l.delta) AS net FROM vlegs l JOIN decided d ON d.id = l.id
                       WHERE d.acc GROUP BY l.acct) n ON n.acct = a.id"""

_ORDER = ["prm", "cust0", "cust_log", "cust1", "cust2", "acct", "txn", "txn_x", "led", "log", "upserts",
          "stg_cust_log", "stg_acct_log", "stg_txn", "stg_txn_written", "stg_led", "stg_cust1", "stg_cust2",
          "stg_acct1", "stg_acct2", "req", "val", "vlegs", "jac(iter, id, acc)", "decided", "after_legs", "dec",
          "post_led", "closing"]
_DEPS = {
    "cust0": [], "prm": [], "cust_log": ["cust0", "prm"], "cust1": ["cust0", "prm"], "cust2": ["cust_log", "prm"],
    "acct": [], "txn": ["prm"], "txn_x": ["txn"], "led": ["txn"], "log": ["cust0", "prm", "acct", "txn", "led"],
    "upserts": ["log"], "stg_cust_log": ["cust_log"], "stg_acct_log": ["acct"], "stg_txn": ["txn_x"],
    "stg_txn_written": ["txn_x"], "stg_led": ["led"], "stg_cust1": ["cust1"], "stg_cust2": ["cust2"],
    "stg_acct1": ["acct"], "stg_acct2": ["acct"], "req": ["txn_x"], "val": ["req", "acct"], "vlegs": ["val"],
    "jac(iter, id, acc)": ["val", "vlegs", "acct"], "decided": ["jac"],
    "after_legs": ["vlegs", "decided", "acct"], "dec": ["val", "decided", "after_legs"],
    "post_led": ["dec"], "closing": ["acct", "vlegs", "decided"],
}


def _name(full: str) -> str:
    return full.split("(")[0].strip()


def _closure(names: list[str]) -> list[str]:
    full = {_name(k): k for k in _ORDER}
    need: set[str] = set()

    def add(n: str):
        key = full[_name(n)]
        if key in need:
            return
        need.add(key)
        for d in _DEPS[key]:
            add(d)

    for n in names:
        add(n)
    return [k for k in _ORDER if k in need]


def with_(extra: dict[str, str] | None, *names: str) -> str:
    """A WITH clause holding the named shared CTEs (and their dependencies) plus ``extra`` ones."""
    keys = _closure(list(names))
    if not keys and not extra:
        return ""
    parts = [f"{k} AS (\n{CTE[k]}\n)" for k in keys]
    parts += [f"{k} AS (\n{v}\n)" for k, v in (extra or {}).items()]
    recursive = "RECURSIVE " if any("(" in k for k in keys) else ""
    return f"WITH {recursive}" + ",\n".join(parts) + "\n"


# ---------------------------------------------------------------- generators
META = "dbt_scd_id, dbt_updated_at, dbt_valid_from, dbt_valid_to"


def _meta(key: str, valid_from: str, valid_to: str) -> str:
    return (f"md5({key} || '|' || strftime({valid_from}, '%Y-%m-%d %H:%M:%S.%f')) AS dbt_scd_id, "
            f"{valid_from} AS dbt_updated_at, {valid_from} AS dbt_valid_from, {valid_to} AS dbt_valid_to")


def scd2_two_runs(s1: str, s2: str, key: str, check: list[str], cols: list[str]) -> str:
    """Snapshot rows after run 1 (source s1 at AS1) and run 2 (source s2 at AS2)."""
    diff = " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in check)
    a_cols = ", ".join(f"a.{c}" for c in cols)
    b_cols = ", ".join(f"b.{c}" for c in cols)
    return f"""SELECT {a_cols}, {_meta('a.' + key, AS1, 'CAST(NULL AS TIMESTAMP)')}
FROM {s1} a LEFT JOIN {s2} b ON a.{key} = b.{key} WHERE b.{key} IS NULL OR NOT ({diff})
UNION ALL
SELECT {a_cols}, {_meta('a.' + key, AS1, AS2)}
FROM {s1} a JOIN {s2} b ON a.{key} = b.{key} WHERE {diff}
UNION ALL
SELECT {b_cols}, {_meta('b.' + key, AS2, 'CAST(NULL AS TIMESTAMP)')}
FROM {s2} b LEFT JOIN {s1} a ON a.{key} = b.{key} WHERE a.{key} IS NULL OR ({diff})"""


def one_run(src: str, key: str, cols: list[str], as_of: str) -> str:
    return f"SELECT {', '.join(cols)}, {_meta(key, as_of, 'CAST(NULL AS TIMESTAMP)')} FROM {src}"


def dq_rows(model: str, src: str, spec: dict, tests=("not_null", "unique", "accepted_values")) -> list[str]:
    out = []
    if "not_null" in tests:
        for c in spec.get("not_null", []):
            out.append(f"SELECT '{model}' AS model, '{c}' AS column_name, 'not_null' AS test, "
                       f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures FROM {src}")
    if "accepted_values" in tests:
        for c, values in spec.get("accepted_values", {}).items():
            vals = ", ".join(f"'{v}'" for v in values)
            out.append(f"SELECT '{model}' AS model, '{c}' AS column_name, 'accepted_values' AS test, "
                       f"CAST(count(DISTINCT {c}) FILTER (WHERE {c} NOT IN ({vals})) AS BIGINT) AS failures "
                       f"FROM {src}")
    if "unique" in tests:
        for c in spec.get("unique", []):
            out.append(f"SELECT '{model}' AS model, '{c}' AS column_name, 'unique' AS test, "
                       f"CAST(count(*) AS BIGINT) AS failures FROM "
                       f"(SELECT {c} FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)")
    return out


STG_MODEL_SRC = {"stg_customers": "stg_cust_log", "stg_accounts": "stg_acct_log",
                 "stg_transactions": "stg_txn_written", "stg_ledger_entries": "stg_led"}

CUST_COLS = S.STG_CUSTOMERS_COLS
ACCT_COLS = S.STG_ACCOUNTS_COLS
FACT_COLS = ", ".join(S.STG_TRANSACTIONS_COLS)
FACT_COLS_NO_LOAD = ", ".join(c for c in S.STG_TRANSACTIONS_COLS if c != "load_timestamp")


def _dim_sql(snap: str, cols: list[str]) -> str:
    return (f"SELECT {', '.join(cols)}, dbt_valid_from AS effective_from, dbt_valid_to AS effective_to, "
            f"dbt_valid_to IS NULL AS is_current FROM {snap}")


SNAP_CUST = scd2_two_runs("stg_cust1", "stg_cust2", "customer_id", S.CUSTOMER_CHECK_COLS, CUST_COLS)
SNAP_ACCT = scd2_two_runs("stg_acct1", "stg_acct2", "account_id", S.ACCOUNT_CHECK_COLS, ACCT_COLS)
DIMS = {"snap_cust": SNAP_CUST, "snap_acct": SNAP_ACCT,
        "dim_c": _dim_sql("snap_cust", S.DIM_CUSTOMERS_COLS), "dim_a": _dim_sql("snap_acct", S.DIM_ACCOUNTS_COLS)}
DIM_NEEDS = ("stg_cust1", "stg_cust2", "stg_acct1", "stg_acct2")

RUN1 = "SELECT * FROM stg_txn WHERE txn_time < TIMESTAMP '2024-01-16 00:00:00' AND e % 50 <> 0"


def _facts_two(lateness: str | None, upsert: bool = False) -> str:
    lower = "(SELECT m FROM mark)" + (f" - INTERVAL '{lateness}'" if lateness else "")
    src2 = "stg_txn2" if upsert else "stg_txn"
    extra = {"run1": RUN1, "mark": "SELECT max(txn_time) AS m FROM run1"}
    if upsert:
        extra["stg_txn2"] = ("SELECT * REPLACE (CASE WHEN e % 25 = 3 THEN 'REVERSED' ELSE txn_status END "
                             "AS txn_status) FROM stg_txn")
        # every id that run 1 loaded is re-sent and so updated; a new one must be newer than the bound
        body = (f"SELECT {FACT_COLS_NO_LOAD}, {AS2} AS load_timestamp FROM {src2} "
                f"WHERE transaction_id IN (SELECT transaction_id FROM run1) OR txn_time > {lower}")
    else:
        body = (f"SELECT {FACT_COLS_NO_LOAD}, {AS1} AS load_timestamp FROM run1\n"
                f"UNION ALL SELECT {FACT_COLS_NO_LOAD}, {AS2} FROM {src2} WHERE txn_time > {lower} "
                f"AND transaction_id NOT IN (SELECT transaction_id FROM run1)")
    return with_(extra, "stg_txn") + body


# ---------------------------------------------------------------- the oracle per query
Q: dict[str, str] = {}

Q["cdc_unwrap"] = with_(None, "log") + "SELECT table_name, op, seq, ts_ms, row_id FROM log"
Q["cdc_drop_deletes"] = with_(None, "upserts") + "SELECT table_name, op, seq, row_id FROM upserts"
Q["cdc_route_topic"] = with_(None, "log") + """SELECT table_name, count(*) AS events,
       count(*) FILTER (WHERE op <> 'd') AS upserts, count(*) FILTER (WHERE op = 'd') AS deletes
FROM log GROUP BY table_name"""
_sizes = " UNION ALL ".join(f"SELECT '{t}' AS table_name, {n} AS batch_size" for t, n in S.FLUSH_SIZES.items())
Q["cdc_flush_batches"] = with_({"sizes": _sizes}, "upserts") + """SELECT u.table_name, s.batch_size,
       count(*) AS rows, CAST(0 AS BIGINT) AS oversize_files
FROM upserts u JOIN sizes s USING (table_name) GROUP BY u.table_name, s.batch_size"""
Q["landing_daily_scan"] = with_(None, "upserts") + """SELECT seq, row_id, day AS date FROM upserts
WHERE table_name = 'transactions' AND day = DATE '2024-01-02'"""
Q["raw_load"] = with_(None, "upserts") + "SELECT table_name, seq, ts_ms, row_id FROM upserts"
Q["load_report"] = with_(None, "upserts") + """SELECT table_name, count(DISTINCT day) AS files, count(*) AS rows
FROM upserts GROUP BY table_name"""
Q["ingest_run"] = Q["load_report"]
Q["ingest_two_days"] = with_(None, "upserts") + f"""SELECT table_name, count(DISTINCT day) AS files, count(*) AS rows
FROM upserts WHERE ts_ms >= {DAY2_MS} GROUP BY table_name"""
Q["raw_load_quarantine"] = with_(None, "upserts") + """SELECT table_name, count(*) FILTER (WHERE table_name <> 'accounts' OR seq >= 100) AS rows_before,
       CAST(CASE WHEN table_name = 'accounts' THEN 1 ELSE 0 END AS BIGINT) AS rejected_before, count(*) AS rows_after,
       CAST(0 AS BIGINT) AS rejected_after FROM upserts GROUP BY table_name"""
Q["raw_scan"] = with_(None, "upserts") + "SELECT seq, row_id, day AS date FROM upserts WHERE table_name = 'accounts'"
Q["cdc_read_batch"] = Q["cdc_unwrap"]
Q["landing_unlisted_table"] = with_(None, "upserts") + """SELECT table_name, count(*) AS rows,
       CAST(0 AS BIGINT) AS oversize_files FROM upserts GROUP BY table_name"""
Q["landing_no_timestamp"] = with_({
    "ev": """SELECT id, CASE WHEN id % 7 = 3 THEN 'bad' ELSE 'upsert' END AS kind,
       CASE WHEN id % 7 = 3 OR id % 3 = 1 THEN DATE '2024-03-05' ELSE DATE '2024-01-01' END AS date FROM acct"""}, "acct") + \
    """SELECT kind, date, count(*) AS events FROM ev GROUP BY kind, date
UNION ALL SELECT 'loaded', date, count(*) FROM ev WHERE kind = 'upsert' AND date = DATE '2024-03-05' GROUP BY date"""
_cur = " UNION ALL ".join(f"SELECT '{c}' AS code, '{n}' AS name" for c, n in S.CURRENCIES)
Q["currencies"] = with_({"cur": _cur}, "stg_acct_log") + """SELECT a.currency, c.name AS currency_name,
       count(*) AS accounts FROM stg_acct_log a LEFT JOIN cur c ON a.currency = c.code GROUP BY a.currency, c.name"""

_CUST_FLAT = ", ".join(c for c in CUST_COLS if c != "load_timestamp")
Q["variant_flatten"] = with_({
    "imgs": f"""SELECT {_CUST_FLAT}, 4 * CAST(customer_id AS BIGINT) AS _seq FROM stg_cust1
UNION ALL
SELECT {_CUST_FLAT}, 4 * CAST(customer_id AS BIGINT) + 1 FROM stg_cust2, prm
WHERE CAST(customer_id AS BIGINT) >= cutoff OR CAST(customer_id AS BIGINT) % 10 IN (0, 5)"""},
    "stg_cust1", "stg_cust2", "prm") + "SELECT * FROM imgs"
_IMAGES = {"imgs": f"""SELECT CAST(k AS VARCHAR) AS customer_id, address AS cust_address, created_at,
       {DAY1_MS} + k * 1000 AS _ts_ms, 4 * k AS _seq, k FROM cust0
UNION ALL SELECT CAST(k AS VARCHAR), address, created_at + INTERVAL 1 HOUR, {DAY1_MS} + k * 1000 - 1, 4 * k + 2, k
       FROM cust0 WHERE k % 4 = 1
UNION ALL SELECT CAST(k AS VARCHAR), 'MOVED', created_at, {DAY1_MS} + k * 1000 + 1, 4 * k + 2, k
       FROM cust0 WHERE k % 4 = 2"""}
Q["latest_per_key"] = with_(_IMAGES, "cust0") + """SELECT customer_id, cust_address, created_at, _ts_ms, _seq FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY created_at DESC NULLS FIRST, _seq DESC) AS rn
  FROM imgs) WHERE rn = 1"""
Q["latest_per_key_tiebreak"] = with_(_IMAGES, "cust0") + """SELECT customer_id, cust_address, created_at, _ts_ms, _seq
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
        ORDER BY created_at DESC NULLS FIRST, _ts_ms DESC, _seq DESC) AS rn FROM imgs) WHERE rn = 1"""
Q["stg_customers"] = with_(None, "stg_cust_log") + "SELECT * FROM stg_cust_log"
Q["stg_accounts"] = with_(None, "stg_acct_log") + "SELECT * FROM stg_acct_log"
Q["stg_transactions"] = with_(None, "stg_txn") + f"SELECT {FACT_COLS} FROM stg_txn"
Q["stg_transactions_as_written"] = with_(None, "stg_txn_written") + f"SELECT {FACT_COLS} FROM stg_txn_written"
Q["stg_ledger_entries"] = with_(None, "stg_led") + "SELECT * FROM stg_led"

Q["scd2_customers_day1"] = with_({"s": one_run("stg_cust1", "customer_id", CUST_COLS, AS1)}, "stg_cust1") + \
    "SELECT * FROM s"
Q["scd2_customers_day2"] = with_({"s": SNAP_CUST}, "stg_cust1", "stg_cust2") + "SELECT * FROM s"
Q["scd2_rerun_noop"] = Q["scd2_customers_day2"]
_DAYS = ", ".join(c for c in CUST_COLS if c != "load_timestamp")
Q["stream_scd2"] = with_({"s": SNAP_CUST}, "stg_cust1", "stg_cust2") + f"""SELECT {_DAYS},
       CAST(dbt_valid_from - INTERVAL 1 DAY AS DATE) AS valid_from, CAST(dbt_valid_to - INTERVAL 1 DAY AS DATE) AS valid_to FROM s"""
Q["scd2_same_day_batches"] = with_({
    "n": "SELECT *, CAST(customer_id AS BIGINT) AS k FROM stg_cust1",
    "v": """SELECT customer_id, phone, TIMESTAMP '2024-01-02 00:00:00' AS since,
       CASE WHEN k % 10 = 0 THEN TIMESTAMP '2024-01-02 10:30:00'
            WHEN k % 5 = 0 THEN TIMESTAMP '2024-01-02 10:30:00.000001' END AS until FROM n
UNION ALL SELECT customer_id, '555-1111', TIMESTAMP '2024-01-02 10:30:00', TIMESTAMP '2024-01-02 10:30:00.000001' FROM n WHERE k % 10 = 0
UNION ALL SELECT customer_id, '555-2222', TIMESTAMP '2024-01-02 10:30:00.000001', NULL FROM n WHERE k % 5 = 0"""}, "stg_cust1") + \
    """SELECT customer_id, phone, md5(customer_id || '|' || strftime(since, '%Y-%m-%d %H:%M:%S.%f')) AS dbt_scd_id,
       since AS dbt_valid_from, until AS dbt_valid_to FROM v"""
Q["scd2_accounts_day2"] = with_({"s": SNAP_ACCT}, "stg_acct1", "stg_acct2") + "SELECT * FROM s"
Q["dim_customers"] = with_(DIMS, *DIM_NEEDS) + "SELECT * FROM dim_c"
Q["dim_accounts"] = with_(DIMS, *DIM_NEEDS) + "SELECT * FROM dim_a"

Q["facts_full"] = with_(None, "stg_txn") + f"SELECT {FACT_COLS} FROM stg_txn"
Q["stream_facts"] = Q["stream_facts_repeats"] = Q["facts_full"]
Q["facts_incremental"] = _facts_two(None)
Q["facts_incremental_late"] = _facts_two("7 days")
Q["facts_upsert"] = _facts_two("7 days", upsert=True)
Q["facts_null_time_rerun"] = with_(None, "stg_txn") + f"""SELECT transaction_id,
       CASE WHEN CAST(transaction_id AS BIGINT) % 5 <> 0 THEN txn_time END AS txn_time,
       CASE WHEN CAST(transaction_id AS BIGINT) % 5 <> 0 THEN {AS2} ELSE {AS1} END AS load_timestamp FROM stg_txn"""
Q["stream_facts_second_checkpoint"] = Q["facts_incremental"]
Q["facts_upsert_interrupted"] = with_({
    "run1": RUN1, "mark": "SELECT max(txn_time) AS m FROM run1",
    "stg_txn2": "SELECT * REPLACE (CASE WHEN e % 25 = 3 THEN 'REVERSED' ELSE txn_status END AS txn_status) FROM stg_txn"}, "stg_txn") + f"""
SELECT {FACT_COLS_NO_LOAD}, {AS1} AS load_timestamp, 'during' AS seen FROM run1
UNION ALL SELECT {FACT_COLS_NO_LOAD}, {AS2}, 'after' FROM stg_txn2
WHERE transaction_id IN (SELECT transaction_id FROM run1) OR txn_time > (SELECT m FROM mark) - INTERVAL '7 days'"""
Q["high_water_mark"] = with_({"run1": RUN1}, "stg_txn") + \
    "SELECT max(txn_time) AS high_water, count(*) AS loaded FROM run1"

Q["direction_rule"] = with_(None, "txn_x") + "SELECT id AS transaction_id, txn_type, direction FROM txn_x"
Q["txn_description"] = with_(None, "txn_x") + "SELECT id AS transaction_id, txn_desc FROM txn_x"
Q["account_number"] = with_(None, "acct") + f"""SELECT id AS account_id,
       '{S.ACCOUNT_NUMBER_PREFIX}' || lpad(CAST({S.ACCOUNT_NUMBER_START} - 1 + row_number() OVER (ORDER BY id)
       AS VARCHAR), 10, '0') AS account_number FROM acct"""
Q["account_number_batches"] = with_(None, "acct") + f"""SELECT id AS account_id,
       '{S.ACCOUNT_NUMBER_PREFIX}' || lpad(CAST({S.ACCOUNT_NUMBER_START} - 1 + row_number() OVER (ORDER BY id % 3 <> 1, id)
       AS VARCHAR), 10, '0') AS account_number FROM acct"""
Q["as_view"] = with_(DIMS, *DIM_NEEDS) + "SELECT account_type, count(*) AS accounts FROM dim_a WHERE is_current GROUP BY account_type"
Q["round_down_money"] = """SELECT event_id, CAST(sign(x) * floor(abs(x) * 100) / 100 AS DECIMAL(18,2)) AS amount
FROM (SELECT event_id, CAST(CAST(value / 3 AS VARCHAR) AS DECIMAL(38,20)) AS x FROM events)"""
Q["apply_defaults"] = with_(None, "cust0") + f"""SELECT CAST(k AS VARCHAR) AS customer_id,
       CASE WHEN k % 7 = 3 THEN 'ACTIVE' WHEN k % 7 = 5 THEN NULL ELSE status END AS cust_status,
       CASE WHEN k % 11 = 4 THEN {AS1} ELSE created_at END AS created_at FROM cust0"""
Q["clean_text"] = f"""SELECT c.c_custkey AS customer_id,
       CASE WHEN n.n_nationkey IS NULL THEN c.c_mktsegment ELSE n.n_name || ', ' || c.c_mktsegment END AS address,
       left('+1-555-' || lpad(CAST(c.c_custkey AS VARCHAR), 6, '0') || ' x' || CAST(c.c_custkey % 1000 AS VARCHAR), 20)
         AS phone,
       {capitalize('c.c_mktsegment')} AS segment
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey"""

Q["post_validate"] = with_(None, "val") + "SELECT id, reject_reason FROM val"
Q["post_decisions"] = with_(None, "dec") + "SELECT id, accepted, reject_reason, balance_after FROM dec"
Q["stream_posting"] = Q["post_decisions"]
Q["post_balance_after"] = with_(None, "dec") + "SELECT id, balance_after FROM dec WHERE accepted"
Q["ledger_entries"] = with_(None, "post_led") + f"""SELECT id, transaction_id, account_id, entry_type,
       {money('cents')} AS amount, created_at FROM post_led"""
Q["closing_balances"] = with_(None, "closing") + "SELECT account_id, balance FROM closing"
# the request ids run on, so the balance is 10 before each odd id until the first withdrawal and then 0, 5, 10, ...
Q["post_hovering"] = with_(None) + f"""SELECT event_id + 1 AS id, CASE WHEN odd THEN fits ELSE TRUE END AS accepted,
       CASE WHEN odd AND NOT fits THEN 'INSUFFICIENT_FUNDS' END AS reject_reason,
       CASE WHEN odd AND NOT fits THEN NULL ELSE CAST(CASE WHEN odd THEN 0 WHEN pos % 4 = 1 THEN 5 ELSE 10 END AS DECIMAL(18,2)) END AS balance_after
FROM (SELECT event_id, (event_id + 1) % 2 = 1 AS odd, pos, pos % 4 = 0 AS fits
      FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS pos FROM events))"""
_BAD_LED = {"bad_led": """SELECT id, transaction_id, account_id, entry_type,
       cents + CASE WHEN transaction_id % 101 = 4 AND id % 2 = 0 THEN 1 ELSE 0 END AS cents FROM post_led
WHERE transaction_id % 97 <> 3 OR id % 2 <> 1"""}
Q["ledger_balance_check"] = with_(_BAD_LED, "post_led") + f"""SELECT transaction_id, count(*) AS entries,
       {money("sum(CASE WHEN entry_type = 'DEBIT' THEN cents ELSE 0 END)", 'DECIMAL(38,2)')} AS debits,
       {money("sum(CASE WHEN entry_type = 'CREDIT' THEN cents ELSE 0 END)", 'DECIMAL(38,2)')} AS credits
FROM bad_led GROUP BY transaction_id
HAVING count(*) <> 2 OR sum(CASE WHEN entry_type = 'DEBIT' THEN cents ELSE -cents END) <> 0"""
Q["balance_reconcile"] = with_({
    "net": """SELECT account_id, sum(CASE WHEN entry_type = 'DEBIT' THEN cents ELSE -cents END) AS net
FROM post_led WHERE account_id IS NOT NULL GROUP BY account_id""",
    "expd": """SELECT COALESCE(a.id, n.account_id) AS account_id, a.cents1 + COALESCE(n.net, 0) AS expected
FROM acct a FULL JOIN net n ON a.id = n.account_id""",
    "closed": "SELECT account_id, balance + CASE WHEN account_id % 53 = 2 THEN 1 ELSE 0 END AS balance FROM closing"},
    "post_led", "closing", "acct") + f"""SELECT
       COALESCE(x.account_id, c.account_id) AS account_id, {money('x.expected', 'DECIMAL(38,2)')} AS expected,
       CAST(c.balance AS DECIMAL(38,2)) AS closing
FROM expd x FULL JOIN closed c ON x.account_id = c.account_id
WHERE {money('x.expected', 'DECIMAL(38,2)')} IS DISTINCT FROM c.balance"""
Q["reject_report"] = with_(None, "dec") + f"""SELECT reject_reason, count(*) AS requests,
       {money('sum(cents)', 'DECIMAL(38,2)')} AS amount FROM dec WHERE NOT accepted GROUP BY reject_reason"""

# data tests
_STG_NEEDS = tuple(STG_MODEL_SRC.values())


def _dq(tests) -> str:
    rows = []
    for model, src in STG_MODEL_SRC.items():
        rows += dq_rows(model, src, S.DATA_TESTS[model], tests)
    return with_(None, *_STG_NEEDS) + "\nUNION ALL\n".join(rows)


Q["dq_not_null"] = _dq(("not_null",))
Q["dq_unique"] = _dq(("unique",))
_KEY = {"stg_customers": "customer_id", "stg_accounts": "account_id", "stg_transactions": "transaction_id", "stg_ledger_entries": "id"}
_odd, _odd_rows = {}, []
for _model, _src in STG_MODEL_SRC.items():
    _k = f"CAST({_KEY[_model]} AS BIGINT)"
    _spec = S.DATA_TESTS[_model]
    _cols = ", ".join(f"CASE WHEN {_k} % 43 = 1 THEN 'ODD' || CAST({_k} % 2 AS VARCHAR) ELSE {c} END AS {c}" for c in _spec["accepted_values"])
    _odd["odd_" + _model] = f"SELECT {_cols} FROM {_src}"
    _odd_rows += dq_rows(_model, "odd_" + _model, _spec, ("accepted_values",))
Q["dq_accepted_values"] = with_(_odd, *_STG_NEEDS) + "\nUNION ALL\n".join(_odd_rows)
Q["dq_suite_staging"] = _dq(("not_null", "unique", "accepted_values"))

_FACTS_INC = {"run1": RUN1, "mark": "SELECT max(txn_time) AS m FROM run1",
              "fact_inc": f"""SELECT {FACT_COLS_NO_LOAD} FROM run1 UNION ALL SELECT {FACT_COLS_NO_LOAD} FROM stg_txn
WHERE txn_time > (SELECT m FROM mark) AND transaction_id NOT IN (SELECT transaction_id FROM run1)"""}
_an_rows = (dq_rows("facts_transactions", "fact_inc", S.DATA_TESTS["facts_transactions"])
            + dq_rows("dim_customers", "(SELECT * FROM dim_c WHERE is_current)", S.DATA_TESTS["dim_customers"])
            + dq_rows("dim_accounts", "(SELECT * FROM dim_a WHERE is_current)", S.DATA_TESTS["dim_accounts"]))
Q["dq_suite_analytics"] = with_({**_FACTS_INC, **DIMS}, "stg_txn", *DIM_NEEDS) + "\nUNION ALL\n".join(_an_rows)


def _checks(model: str, src: str, checks: dict[str, str]) -> list[str]:
    return [f"SELECT '{model}' AS model, '{name}' AS column_name, 'check' AS test, "
            f"CAST(count(*) FILTER (WHERE NOT ({cond})) AS BIGINT) AS failures FROM {src}"
            for name, cond in checks.items()]


def _in(col: str, values) -> str:
    return f"{col} IN ({', '.join(repr(v) for v in values)})"


_LONG = "repeat('x', 300)"
_OLTP = {"cust_good": f"""SELECT k AS id, CASE WHEN k % 37 = 5 THEN {_LONG} ELSE first_name END AS first_name, last_name,
       CASE WHEN k % 41 = 3 THEN NULL ELSE email END AS email, phone, CASE WHEN k % 43 = 1 THEN 'ODD' ELSE status END AS status FROM cust0""",
         "cust_oltp": "SELECT * FROM cust_good UNION ALL SELECT * FROM cust_good WHERE id % 50 = 7",
         "acct_good": f"""SELECT id, CASE WHEN id % 59 = 4 THEN -id - 1 ELSE k END AS customer_id,
       CASE WHEN id % 61 = 2 THEN 'ODD' ELSE account_type END AS account_type, CASE WHEN id % 43 = 1 THEN 'ODD' ELSE status END AS status,
       CASE WHEN id % 67 = 3 THEN {_LONG} ELSE
       '{S.ACCOUNT_NUMBER_PREFIX}' || lpad(CAST(id + {S.ACCOUNT_NUMBER_START} AS VARCHAR), 10, '0') END AS account_number FROM acct""",
         "acct1": "SELECT * FROM acct_good UNION ALL SELECT * FROM acct_good WHERE id % 71 = 0",
         "txn_good": f"""SELECT id, account_id, related_account_id, CASE WHEN id % 97 = 8 THEN 'ODD' ELSE txn_type END AS txn_type,
       CASE WHEN id % 79 = 5 THEN 'ODD' ELSE direction END AS direction, CASE WHEN id % 89 = 6 THEN 'ODD' ELSE status END AS status,
       CASE WHEN id % 73 = 6 THEN {_LONG} ELSE reference END AS reference, cents FROM req""",
         "txn1": "SELECT * FROM txn_good UNION ALL SELECT * FROM txn_good WHERE id % 83 = 0",
         "led_all": """SELECT 2 * id AS id, id AS transaction_id, account_id,
       CASE WHEN txn_type = 'DEPOSIT' THEN 'DEBIT' ELSE 'CREDIT' END AS entry_type, cents FROM req
UNION ALL SELECT 2 * id + 1, id, CASE WHEN txn_type = 'TRANSFER' THEN related_account_id END,
       CASE WHEN txn_type = 'DEPOSIT' THEN 'CREDIT' ELSE 'DEBIT' END, cents FROM req""",
         "led_good": """SELECT id, CASE WHEN id % 101 = 9 THEN -id ELSE transaction_id END AS transaction_id, account_id,
       CASE WHEN id % 71 = 2 THEN 'ODD ENTRY TYPE' ELSE entry_type END AS entry_type, cents FROM led_all""",
         "req_led": "SELECT * FROM led_good UNION ALL SELECT * FROM led_good WHERE id % 91 = 1"}
_OLTP_NEEDS = ("req", "cust0", "acct")
Q["dq_check"] = with_(_OLTP, *_OLTP_NEEDS) + "\nUNION ALL\n".join(
    _checks("customers", "cust_oltp", {"status_in": _in("status", S.CUSTOMER_STATUS)})
    + _checks("accounts", "acct1", {"account_type_in": _in("account_type", ["SAVINGS", "CHECKING", "CREDIT", "LOAN"]),
                                    "status_in": _in("status", S.ACCOUNT_STATUS)})
    + _checks("transactions", "txn1", {"txn_type_in": _in("txn_type", S.TXN_TYPES),
                                      "direction_in": _in("direction", S.DIRECTIONS),
                                      "amount_positive": "cents > 0",
                                      "status_in": _in("status", S.TXN_STATUS)})
    + _checks("ledger_entries", "req_led", {"entry_type_in": _in("entry_type", S.ENTRY_TYPES),
                                            "amount_positive": "cents > 0"}))
Q["dq_conditional_check"] = with_(_OLTP, *_OLTP_NEEDS) + "\nUNION ALL\n".join(
    _checks("transactions", "txn1",
            {"transfer_has_destination": "txn_type <> 'TRANSFER' OR related_account_id IS NOT NULL"}))


def _key(model: str, src: str, col: str) -> list[str]:
    return [f"SELECT '{model}' AS model, '{col}' AS column_name, 'not_null' AS test, "
            f"CAST(count(*) FILTER (WHERE {col} IS NULL) AS BIGINT) AS failures FROM {src}",
            f"SELECT '{model}', '{col}', 'unique', CAST(count(*) AS BIGINT) FROM "
            f"(SELECT {col} FROM {src} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1)"]


Q["dq_primary_key"] = with_(_OLTP, *_OLTP_NEEDS) + "\nUNION ALL\n".join(
    _key("customers", "cust_oltp", "id") + _key("customers", "cust_oltp", "email")
    + _key("accounts", "acct1", "id") + _key("accounts", "acct1", "account_number")
    + _key("transactions", "txn1", "id") + _key("ledger_entries", "req_led", "id"))


def _fk(model: str, child: str, col: str, parent: str, key: str) -> str:
    return (f"SELECT '{model}' AS model, '{col}' AS column_name, 'foreign_key' AS test, CAST(count(*) AS BIGINT) "
            f"AS failures FROM {child} c WHERE c.{col} IS NOT NULL AND c.{col} NOT IN (SELECT {key} FROM {parent})")


Q["dq_foreign_key"] = with_(_OLTP, *_OLTP_NEEDS) + "\nUNION ALL\n".join([
    _fk("accounts", "acct1", "customer_id", "cust_oltp", "id"),
    _fk("transactions", "txn1", "account_id", "acct1", "id"),
    _fk("transactions", "txn1", "related_account_id", "acct1", "id"),
    _fk("ledger_entries", "req_led", "transaction_id", "txn1", "id"),
    _fk("ledger_entries", "req_led", "account_id", "acct1", "id")])

_LEN_SRC = {"customers": "cust_oltp", "accounts": "acct1", "transactions": "txn1", "ledger_entries": "req_led"}
_len_rows = [f"SELECT '{t}' AS model, '{c}' AS column_name, 'length<={n}' AS test, "
             f"CAST(count(*) FILTER (WHERE length({c}) > {n}) AS BIGINT) AS failures FROM {src}"
             for t, src in _LEN_SRC.items() for c, n in S.LENGTH_LIMITS[t].items()]
Q["dq_length"] = with_(_OLTP, *_OLTP_NEEDS) + "\nUNION ALL\n".join(_len_rows)

# KPIs over the day-2 dimensions and the full fact
_CUR_A = "(SELECT a.*, CAST(round(a.balance * 100) AS BIGINT) AS cents FROM dim_a a WHERE is_current)"
Q["kpi_total_balance"] = with_(DIMS, *DIM_NEEDS) + \
    f"SELECT {money('sum(cents)', 'DECIMAL(38,2)')} AS total_balance FROM {_CUR_A}"
Q["kpi_avg_balance"] = with_(DIMS, *DIM_NEEDS) + \
    f"SELECT CAST(sum(cents) AS DOUBLE) / CAST(count(cents) * 100 AS DOUBLE) AS avg_balance FROM {_CUR_A}"
Q["kpi_total_accounts"] = with_(DIMS, *DIM_NEEDS) + \
    "SELECT count(DISTINCT account_id) AS total_accounts FROM dim_a WHERE is_current"
Q["kpi_total_customers"] = with_(DIMS, *DIM_NEEDS) + \
    "SELECT count(DISTINCT customer_id) AS total_customers FROM dim_c WHERE is_current"
Q["kpi_avg_balance_by_type"] = with_(DIMS, *DIM_NEEDS) + f"""SELECT account_type,
       CAST(sum(cents) AS DOUBLE) / CAST(count(cents) * 100 AS DOUBLE) AS avg_balance, count(*) AS accounts
FROM {_CUR_A} GROUP BY account_type"""
Q["kpi_customer_balance"] = with_(DIMS, *DIM_NEEDS) + f"""SELECT a.customer_id,
       {money('sum(a.cents)', 'DECIMAL(38,2)')} AS total_balance, count(*) AS accounts
FROM {_CUR_A} a WHERE a.customer_id IN (SELECT customer_id FROM dim_c WHERE is_current) GROUP BY a.customer_id"""
Q["kpi_total_transactions"] = with_(None, "txn") + "SELECT count(*) AS total_transactions FROM txn"
Q["kpi_amount_over_time"] = with_(None, "txn") + f"""SELECT date_trunc('day', created_at) AS period,
       {money('sum(cents)', 'DECIMAL(38,2)')} AS total_amount, count(*) AS txn_count FROM txn GROUP BY 1"""
Q["kpi_amount_by_txn_type"] = with_(None, "txn") + f"""SELECT txn_type,
       {money('sum(cents)', 'DECIMAL(38,2)')} AS total_amount, count(*) AS txn_count FROM txn GROUP BY txn_type"""

Q["stream_landing"] = with_(None, "upserts") + "SELECT table_name, seq, row_id FROM upserts"
Q["stream_raw"] = Q["raw_load"]

# transform run: row counts and failing tests per model (one snapshot run on the log staging)
_TR = {"dim_c1": "SELECT *, TRUE AS is_current FROM stg_cust_log",
       "dim_a1": "SELECT *, TRUE AS is_current FROM stg_acct_log"}
_tr_tests = {
    "stg_customers": dq_rows("stg_customers", "stg_cust_log", S.DATA_TESTS["stg_customers"]),
    "stg_accounts": dq_rows("stg_accounts", "stg_acct_log", S.DATA_TESTS["stg_accounts"]),
    "stg_transactions": dq_rows("stg_transactions", "stg_txn_written", S.DATA_TESTS["stg_transactions"]),
    "stg_ledger_entries": dq_rows("stg_ledger_entries", "stg_led", S.DATA_TESTS["stg_ledger_entries"]),
    "dim_customers": dq_rows("dim_customers", "dim_c1", S.DATA_TESTS["dim_customers"]),
    "dim_accounts": dq_rows("dim_accounts", "dim_a1", S.DATA_TESTS["dim_accounts"]),
    "facts_transactions": dq_rows("facts_transactions", "stg_txn", S.DATA_TESTS["facts_transactions"]),
}
_tr_rows = {"stg_customers": "stg_cust_log", "stg_accounts": "stg_acct_log", "stg_transactions": "stg_txn_written",
            "stg_ledger_entries": "stg_led", "dim_customers": "dim_c1", "dim_accounts": "dim_a1",
            "facts_transactions": "stg_txn"}
Q["transform_run"] = with_({**_TR, "tests": "\nUNION ALL\n".join(sum(_tr_tests.values(), []))},
                           "stg_cust_log", "stg_acct_log", "stg_txn_written", "stg_led", "stg_txn") + \
    "\nUNION ALL\n".join(
        f"SELECT '{m}' AS model, '{S.MODEL_LAYER[m]}' AS layer, (SELECT count(*) FROM {src}) AS rows, "
        f"(SELECT CAST(count(*) AS BIGINT) FROM tests WHERE model = '{m}' AND failures > 0) AS failed_tests"
        for m, src in _tr_rows.items())

Q["pipeline_e2e"] = with_(None, "stg_acct_log", "stg_cust_log", "txn") + f"""SELECT a.customer_id,
       {money('sum(CAST(round(a.balance * 100) AS BIGINT))', 'DECIMAL(38,2)')} AS total_balance, count(*) AS accounts,
       (SELECT count(*) FROM txn) AS transactions
FROM stg_acct_log a WHERE a.customer_id IN (SELECT customer_id FROM stg_cust_log) GROUP BY a.customer_id"""

Q["dq_transactions_by_load"] = with_(None, "stg_txn_written") + "\nUNION ALL\n".join(_tr_tests["stg_transactions"])
Q["stg_accounts_by_load"] = Q["stg_accounts"]
Q["stg_transactions_by_load"] = Q["stg_transactions_as_written"]

ORACLE = dict(sorted(Q.items()))
