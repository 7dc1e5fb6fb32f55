"""SQL definitions of the shared inputs, for the oracle texts.

They state the same tables as `fixtures` and the operators, in the plainest relational
form (range joins against an explicit panel), so that a match is evidence.
"""

from __future__ import annotations

ANCHOR = "DATE '2001-08-01'"
LOOKBACK, HORIZON = 730, 30
WINDOWS = (60, 90, 180)

VIEWS: dict[str, tuple[str, str]] = {}


def view(name: str, uses: str, text: str) -> None:
    VIEWS[name] = (uses, text)


def with_views(names: list[str], body: str) -> str:
    """Prefix `body` with the views it uses and the views those use, in order."""
    ordered: list[str] = []

    def need(name: str) -> None:
        if name in ordered:
            return
        for parent in VIEWS[name][0].split():
            need(parent)
        ordered.append(name)

    for n in names:
        need(n)
    if not ordered:
        return body
    ctes = ",\n".join(f"{n} AS (\n{VIEWS[n][1].strip()}\n)" for n in ordered)
    return f"WITH {ctes}\n{body}"


def compact(c: str) -> str:
    return f"strftime({c}, '%Y%m%d')"


def parsed(c: str) -> str:
    return f"CAST(try_strptime({c}, '%Y%m%d') AS DATE)"


def either(c: str) -> str:
    return f"coalesce({parsed(c)}, TRY_CAST({c} AS DATE))"


view("ol", "", """
SELECT l.*, o.*, CAST(o.o_orderdate AS DATE) AS base, CAST(l.l_shipdate AS DATE) AS ship
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""")

view("olc", "ol", """
SELECT ol.*, c.*, n.n_name, r.r_name,
  CASE WHEN o_orderstatus = 'F' OR (o_orderstatus = 'P' AND l_linenumber % 2 = 0)
            OR base < DATE '2001-04-03'
       THEN base + CAST(3 + (o_orderkey * 7 + o_custkey) % 140 AS INTEGER) END AS clear,
  CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 7 ELSE 0 END AS cd1,
  CASE WHEN o_orderpriority = '3-MEDIUM' THEN 14 ELSE 0 END AS cd2,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 30 ELSE 0 END AS net,
  CAST(o_orderkey % 3 AS INTEGER) AS disputes
FROM ol JOIN customer c ON ol.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
""")

view("raw", "olc", f"""
SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS customer_id,
  CAST(o_orderkey AS VARCHAR) AS invoice_id, CAST(l_linenumber AS VARCHAR) AS line_item,
  chr(CAST(65 + c_nationkey // 5 AS INTEGER)) || chr(CAST(65 + c_nationkey % 5 AS INTEGER)) || '01' AS company_code,
  l_extendedprice AS invoice_amount,
  CASE WHEN clear IS NULL THEN l_extendedprice ELSE 0 END AS open_amount,
  CASE WHEN o_orderkey % 97 = 0 THEN '00000000' ELSE {compact('base')} END AS baseline_date,
  CAST(base AS VARCHAR) AS document_entry_date, {compact('clear')} AS clearing_date,
  cd1 AS cash_discount_days_1, cd2 AS cash_discount_days_2, net AS net_payment_days,
  CASE WHEN o_orderkey % 2 = 0 THEN CAST(base + (cd1 + cd2 + net) + 2 AS VARCHAR) END AS due_date,
  CAST(coalesce(clear, {ANCHOR}) - (base + (cd1 + cd2 + net)) AS INTEGER) AS days_past_due,
  o_orderstatus AS invoice_status, n_name AS country, r_name AS region,
  CAST(200 + o_custkey % 3000 AS INTEGER) AS customer_tenure_days,
  CASE WHEN l_returnflag = 'R' THEN CAST(1 + l_linenumber % 4 AS INTEGER) END AS dunning_level,
  CASE WHEN l_returnflag = 'R' THEN CAST(ship AS VARCHAR) END AS last_dunned_date,
  CASE WHEN l_returnflag = 'R' THEN CAST(1 + o_orderkey % 3 AS INTEGER) END AS dunning_count,
  CASE WHEN l_returnflag = 'A' THEN floor(l_extendedprice) * 0.5 END AS fin_promised_amt,
  CASE WHEN l_returnflag = 'A' THEN CAST(l_linenumber % 4 AS INTEGER) END AS fin_p2p_state,
  CASE WHEN l_returnflag = 'A' THEN {compact('ship')} END AS promise_dt,
  chr(CAST(65 + o_custkey % 6 AS INTEGER)) AS risk_class, c_mktsegment AS credit_group,
  greatest(c_acctbal, 0) * 10 AS credit_limit,
  CASE WHEN disputes > 0 THEN CAST(base AS VARCHAR) END AS dispute_create_date,
  disputes AS number_of_disputes,
  CASE WHEN disputes > 0 THEN l_extendedprice * 0.1 ELSE 0 END AS open_dispute_amount,
  l_linestatus AS payment_method,
  CASE WHEN clear IS NULL THEN 'bsid' ELSE 'BSAD' END AS source
FROM olc
""")

_TERMS = """coalesce(nullif(net_payment_days, 0), nullif(cash_discount_days_2, 0),
  nullif(cash_discount_days_1, 0), 0)"""

# typed view: valid baseline, known source; country still the master column
view("typed", "raw", f"""
SELECT * REPLACE ({parsed('baseline_date')} AS baseline_date,
  {parsed('clearing_date')} AS clearing_date,
  TRY_CAST(document_entry_date AS DATE) AS document_entry_date,
  {either('due_date')} AS due_date, {either('last_dunned_date')} AS last_dunned_date,
  {either('promise_dt')} AS promise_dt,
  TRY_CAST(dispute_create_date AS DATE) AS dispute_create_date, upper(source) AS source)
FROM raw WHERE {parsed('baseline_date')} IS NOT NULL AND upper(source) IN ('BSID', 'BSAD')
""")

# all history, code country, recomputed due date
view("items_all", "typed", f"""
SELECT * REPLACE (upper(substr(company_code, 1, 2)) AS country,
  baseline_date + {_TERMS} AS due_date), {_TERMS} AS payment_terms_days
FROM typed
""")

view("items", "items_all", f"""
SELECT * FROM items_all WHERE baseline_date >= {ANCHOR} - {LOOKBACK}
""")

_ROLLUP = """
SELECT customer_id, invoice_id, sum(invoice_amount) AS invoice_amount,
  min(baseline_date) AS baseline_date, min(due_date) AS due_date,
  max(clearing_date) AS clearing_date, sum(open_amount) AS open_amount,
  min(country) AS country, min(region) AS region, min(invoice_status) AS invoice_status,
  max(dunning_level) AS dunning_level, max(last_dunned_date) AS last_dunned_date,
  max(dunning_count) AS dunning_count, max(fin_promised_amt) AS fin_promised_amt,
  max(promise_dt) AS promise_dt, min(risk_class) AS risk_class,
  min(credit_group) AS credit_group, max(credit_limit) AS credit_limit,
  max(number_of_disputes) AS number_of_disputes,
  max(open_dispute_amount) AS open_dispute_amount,
  max(customer_tenure_days) AS customer_tenure_days,
  CAST(right(max(CASE WHEN fin_p2p_state IS NOT NULL
    THEN CAST(promise_dt AS VARCHAR) || CAST(fin_p2p_state AS VARCHAR) END), 1) AS INTEGER) AS fin_p2p_state,
  max(CASE WHEN source = 'BSAD' THEN 1 ELSE 0 END) AS is_cleared
FROM {source} GROUP BY customer_id, invoice_id
"""
view("inv", "items", _ROLLUP.format(source="items"))
view("inv_all", "items_all", _ROLLUP.format(source="items_all"))

view("cal", "inv", f"""
SELECT min(d) AS snapshot_date FROM (
  SELECT CAST(unnest(generate_series(CAST((SELECT greatest(min(baseline_date), {ANCHOR} - {LOOKBACK}) FROM inv) AS TIMESTAMP),
    CAST({ANCHOR} - {HORIZON} AS TIMESTAMP), INTERVAL 7 DAY)) AS DATE) AS d)
GROUP BY date_trunc('month', d)
""")

view("panel", "inv cal", """
SELECT customer_id, snapshot_date FROM (SELECT DISTINCT customer_id FROM inv) CROSS JOIN cal
""")

view("letters", "ol", f"""
SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS customer_id,
  CAST(o_orderkey AS VARCHAR) AS invoice_id, ship AS dunning_date,
  CAST(1 + l_linenumber % 4 AS INTEGER) AS dunning_level
FROM ol WHERE l_returnflag = 'R'
""")

view("promises", "ol", f"""
SELECT lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS customer_id,
  lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS invoice_id,
  floor(l_extendedprice) * 0.5 AS promised_amount, CAST(l_linenumber % 4 AS INTEGER) AS promise_state,
  ship AS promise_date
FROM ol WHERE l_returnflag = 'A'
""")

view("master", "", """
SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS customer_id, n_name AS country, r_name AS region
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")

view("openrows", "inv panel", """
SELECT i.*, p.snapshot_date,
  CASE WHEN due_date <= p.snapshot_date THEN p.snapshot_date - due_date ELSE 0 END AS dpd,
  p.snapshot_date - baseline_date AS invoice_age
FROM inv i JOIN panel p ON i.customer_id = p.customer_id AND i.baseline_date <= p.snapshot_date
WHERE clearing_date IS NULL OR clearing_date > p.snapshot_date
""")


def exposure_select(source: str, at: str, back_date: bool = True, country: bool = True) -> str:
    tenure = "max(customer_tenure_days)"
    if back_date:
        tenure = f"greatest({tenure} - CAST({ANCHOR} - {at} AS INTEGER), 0)"
    pct = ",\n  ".join(
        f"sum(CASE WHEN dpd > {b} THEN invoice_amount ELSE 0 END) / nullif(sum(invoice_amount), 0) AS pct_{b}_plus"
        for b in (30, 60, 90))
    amt = ",\n  ".join(
        f"sum(CASE WHEN dpd > {b} THEN invoice_amount ELSE 0 END) AS amt_{b}_plus"
        for b in (30, 60, 90))
    return f"""
SELECT customer_id, snapshot_date, sum(invoice_amount) AS total_outstanding,
  count(DISTINCT invoice_id) AS num_open_invoices, CAST(max(dpd) AS INTEGER) AS max_dpd,
  avg(dpd) AS avg_dpd, {amt}, CAST(max(invoice_age) AS INTEGER) AS oldest_invoice_age,
  avg(invoice_age) AS avg_invoice_age,
  {'min(country) AS country,' if country else ''}
  sum(open_amount) AS total_open_amount, max(credit_limit) AS credit_limit,
  max(number_of_disputes) AS number_of_disputes,
  sum(open_dispute_amount) AS open_dispute_amount, {tenure} AS customer_tenure_days,
  min(risk_class) AS risk_class, min(credit_group) AS credit_group,
  sum(invoice_amount) / count(DISTINCT invoice_id) AS avg_invoice_size, {pct},
  CASE WHEN max(credit_limit) > 0 THEN sum(invoice_amount) / max(credit_limit) ELSE 0 END AS credit_utilization
FROM {source} GROUP BY customer_id, snapshot_date"""


def behaviour_select(source: str, late: str = "days_late", windowed: bool = True) -> str:
    per = []
    for w in WINDOWS:
        inside = f"clearing_date >= snapshot_date - {w}"
        per.append(f"""avg(CASE WHEN {inside} THEN days_to_pay END) AS avg_days_to_pay_{w}d,
  CAST(max(CASE WHEN {inside} THEN days_to_pay END) AS INTEGER) AS max_days_to_pay_{w}d,
  {f"avg(CASE WHEN {inside} THEN CASE WHEN {late} <= 0 THEN 1 ELSE 0 END END)" if windowed else
   f"avg(CASE WHEN {inside} AND {late} <= 0 THEN 1 ELSE 0 END)"} AS on_time_ratio_{w}d,
  count(CASE WHEN {inside} THEN 1 END) AS num_payments_{w}d""")
    return f"""
SELECT customer_id, snapshot_date, avg(days_to_pay) AS avg_days_to_pay,
  CAST(max(days_to_pay) AS INTEGER) AS max_days_to_pay,
  avg(CASE WHEN {late} <= 0 THEN 1 ELSE 0 END) AS on_time_ratio,
  count(*) AS total_payments, CAST(snapshot_date - max(clearing_date) AS INTEGER) AS days_since_last_payment,
  {', '.join(per)}
FROM {source} GROUP BY customer_id, snapshot_date"""


def dunning_select(source: str, date: str, weight: str = "1") -> str:
    per = []
    for w in WINDOWS:
        inside = f"{date} >= snapshot_date - {w}"
        per.append(f"""CAST(coalesce(sum(CASE WHEN {inside} THEN {weight} END), 0) AS BIGINT) AS dunning_events_{w}d,
  CAST(coalesce(sum(CASE WHEN {inside} AND dunning_level >= 3 THEN {weight} END), 0) AS BIGINT) AS high_severity_dunning_{w}d""")
    high = f"coalesce(sum(CASE WHEN dunning_level >= 3 THEN {weight} END), 0)"
    return f"""
SELECT customer_id, snapshot_date, max(dunning_level) AS max_dunning_level,
  CAST(sum({weight}) AS BIGINT) AS total_dunning_events, avg(dunning_level) AS avg_dunning_level,
  CAST({high} AS BIGINT) AS high_severity_dunning,
  CASE WHEN sum({weight}) > 0 THEN {high} / sum({weight}) ELSE 0 END AS high_dunning_ratio,
  {', '.join(per)}
FROM {source} GROUP BY customer_id, snapshot_date"""


def promise_select(source: str, date: str, state: str, amount: str) -> str:
    per = []
    for w in WINDOWS:
        inside = f"{date} >= snapshot_date - {w}"
        per.append(f"""count(CASE WHEN {inside} THEN 1 END) AS promises_{w}d,
  count(CASE WHEN {inside} AND {state} = 1 THEN 1 END) AS broken_{w}d,
  count(CASE WHEN {inside} AND {state} = 3 THEN 1 END) AS kept_{w}d,
  sum(CASE WHEN {inside} THEN {amount} END) AS promised_amt_{w}d""")
    return f"""
SELECT customer_id, snapshot_date, count(*) AS total_promises,
  count(CASE WHEN {state} = 1 THEN 1 END) AS broken_promises,
  count(CASE WHEN {state} = 3 THEN 1 END) AS kept_promises, sum({amount}) AS total_promised_amount,
  count(CASE WHEN {state} = 1 THEN 1 END) / count(*) AS broken_ratio,
  count(CASE WHEN {state} = 3 THEN 1 END) / count(*) AS kept_ratio,
  sum({amount}) / count(*) AS avg_promised_amount, 1 AS promise_activity_flag,
  {', '.join(per)}
FROM {source} GROUP BY customer_id, snapshot_date"""


def history(name: str, events: str, date: str, uses: str, extra: str = "",
            spine: str = "panel", floor: int | None = None) -> None:
    lower = f"AND e.{date} >= p.snapshot_date - {floor}" if floor else ""
    view(name, f"{uses} {spine}", f"""
SELECT e.*, p.snapshot_date{extra} FROM {events} e
JOIN {spine} p ON e.customer_id = p.customer_id AND e.{date} <= p.snapshot_date {lower}
""")


_DAYS = """, e.clearing_date - e.baseline_date AS days_to_pay,
  e.clearing_date - e.due_date AS days_late"""
history("paid", "inv", "clearing_date", "inv", _DAYS)
history("dunned_view", "inv", "last_dunned_date", "inv")
history("promised_view", "inv", "promise_dt", "inv")
history("dunned", "letters", "dunning_date", "letters")
history("promised", "promises", "promise_date", "promises")

view("expo", "openrows", exposure_select("openrows", "snapshot_date"))
view("behav", "paid", behaviour_select("paid"))
view("dunn", "dunned", dunning_select("dunned", "dunning_date"))
view("prom", "promised", promise_select("promised", "promise_date", "promise_state", "promised_amount"))
view("dunn_view", "dunned_view", dunning_select("dunned_view", "last_dunned_date", "dunning_count"))
view("prom_view", "promised_view",
     promise_select("promised_view", "promise_dt", "fin_p2p_state", "fin_promised_amt"))
view("label", "openrows", f"""
SELECT customer_id, snapshot_date, sum(invoice_amount) AS collected_30d FROM openrows
WHERE clearing_date >= snapshot_date AND clearing_date <= snapshot_date + {HORIZON}
GROUP BY customer_id, snapshot_date
""")


# feature columns by SQL type, used by assembly texts and rounding specs
def _w(*stems: str) -> list[str]:
    return [f"{s}_{w}d" for w in WINDOWS for s in stems]


MONEY_COLS = ["total_outstanding", "amt_30_plus", "amt_60_plus", "amt_90_plus",
              "total_open_amount", "credit_limit", "open_dispute_amount"]
RATIO_COLS = ["avg_dpd", "avg_invoice_age", "pct_30_plus", "pct_60_plus", "pct_90_plus",
              "credit_utilization", "avg_invoice_size"]
EXPOSURE_SPEC = " ".join([f"{c}:4" for c in MONEY_COLS] + [f"{c}:6" for c in RATIO_COLS]
                         + ["snapshot_date:d"])
BEHAVIOUR_SPEC = " ".join(
    f"{c}:6" for c in ["avg_days_to_pay", "on_time_ratio",
                           *_w("avg_days_to_pay", "max_days_to_pay", "on_time_ratio")]
) + " snapshot_date:d"
DUNNING_SPEC = "avg_dunning_level:6 high_dunning_ratio:6 snapshot_date:d"
PROMISE_SPEC = " ".join(
    ["broken_ratio:6", "kept_ratio:6", "total_promised_amount:4", "avg_promised_amount:6"]
    + [f"{c}:4" for c in _w("promised_amt")]) + " snapshot_date:d"
LABEL_SPEC = "collected_30d:4 collection_ratio:6 snapshot_date:d"


def merged_spec(*specs: str) -> str:
    return " ".join(dict.fromkeys(" ".join(specs).split()))


TRAIN_SPEC = merged_spec(EXPOSURE_SPEC, BEHAVIOUR_SPEC, DUNNING_SPEC, PROMISE_SPEC, LABEL_SPEC)

NUMERIC_FEATURES = [
    "total_outstanding", "num_open_invoices", "max_dpd", "avg_dpd", "amt_30_plus", "amt_60_plus",
    "amt_90_plus", "oldest_invoice_age", "avg_invoice_age", "total_open_amount", "credit_limit",
    "number_of_disputes", "open_dispute_amount", "customer_tenure_days", "avg_invoice_size",
    "pct_30_plus", "pct_60_plus", "pct_90_plus", "credit_utilization",
    "avg_days_to_pay", "max_days_to_pay", "on_time_ratio", "total_payments",
    "days_since_last_payment",
    *_w("avg_days_to_pay", "max_days_to_pay", "on_time_ratio", "num_payments"),
    "max_dunning_level", "total_dunning_events", "avg_dunning_level", "high_severity_dunning",
    "high_dunning_ratio", *_w("dunning_events", "high_severity_dunning"),
    "total_promises", "broken_promises", "kept_promises", "total_promised_amount",
    "broken_ratio", "kept_ratio", "avg_promised_amount", "promise_activity_flag",
    *_w("promises", "broken", "kept", "promised_amt"),
]
PANEL_FEATURES = NUMERIC_FEATURES[:19]  # the exposure block
_FILLED = ",\n  ".join(f"coalesce({c}, 0) AS {c}" for c in NUMERIC_FEATURES)


def train_select(dunning: str, promise: str) -> str:
    return f"""
SELECT *, CASE WHEN collection_ratio < 0.4 THEN 1 ELSE 0 END AS target FROM (
SELECT e.customer_id, e.snapshot_date, e.country, e.risk_class, e.credit_group,
  {_FILLED}, coalesce(collected_30d, 0) AS collected_30d,
  coalesce(collected_30d, 0) / total_outstanding AS collection_ratio
FROM expo e LEFT JOIN behav USING (customer_id, snapshot_date)
LEFT JOIN {dunning} USING (customer_id, snapshot_date)
LEFT JOIN {promise} USING (customer_id, snapshot_date)
LEFT JOIN label USING (customer_id, snapshot_date) WHERE total_outstanding > 0)"""


view("train", "expo behav dunn prom label", train_select("dunn", "prom"))
view("train_view", "expo behav dunn_view prom_view label", train_select("dunn_view", "prom_view"))
