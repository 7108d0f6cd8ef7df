"""DuckDB SQL for each catalog entry: the correctness oracle.

Written from the reference's SQL semantics (sequential rule inserts, NULL
rules of PostgreSQL), over the same driver tables. Parameters are the
catalog's. Open SCD2 ends are NULL, as in the catalog output.
"""

from __future__ import annotations

FIXTURES = """
fx_terminals AS (
  SELECT 'T'||CAST(s_suppkey AS VARCHAR) terminal_id,
         CASE WHEN s_suppkey%2=0 THEN 'ATM' ELSE 'POS' END terminal_type,
         n_name terminal_city, s_name terminal_address
  FROM supplier JOIN nation ON s_nationkey=n_nationkey),
fx_tx_all AS (
  SELECT CAST(event_id AS VARCHAR) trans_id, ts trans_date,
         'C'||CAST(user_id AS VARCHAR) card_num,
         CASE event_type WHEN 'purchase' THEN 'PAYMENT' WHEN 'click' THEN 'WITHDRAW'
                         WHEN 'view' THEN 'PAYMENT' ELSE 'DEPOSIT' END oper_type,
         CAST(value AS DECIMAL(18,2)) amt,
         CASE WHEN event_type='purchase' THEN 'SUCCESS' ELSE 'REJECT' END oper_result,
         'T'||CAST(event_id%(SELECT count(*) FROM supplier) AS VARCHAR) terminal
  FROM events),
fx_cards AS (SELECT 'C'||CAST(c_custkey AS VARCHAR)||' ' card_num, 'A'||CAST(c_custkey AS VARCHAR) account_num
             FROM customer),
fx_accounts AS (SELECT 'A'||CAST(c_custkey AS VARCHAR) account_num,
                       DATE '2024-01-01'+CAST(c_custkey%45 AS INT) valid_to,
                       CAST(c_custkey AS VARCHAR) client FROM customer),
fx_clients AS (SELECT CAST(c_custkey AS VARCHAR) client_id, c_name last_name, c_mktsegment first_name,
                      CASE WHEN c_custkey%11=0 THEN NULL ELSE n_name END patronymic,
                      'P'||CAST(c_custkey AS VARCHAR) passport_num,
                      CASE WHEN c_custkey%7=0 THEN NULL ELSE DATE '2024-01-01'+CAST(c_custkey%60 AS INT) END
                        passport_valid_to,
                      '+7'||CAST(c_custkey AS VARCHAR) phone
               FROM customer JOIN nation ON c_nationkey=n_nationkey),
fx_blacklist AS (SELECT 'P'||CAST(c_custkey AS VARCHAR) passport_num,
                        DATE '2024-01-01'+CAST(c_custkey%20 AS INT) entry_dt
                 FROM customer WHERE c_custkey%10=0),
owner AS (SELECT trim(c.card_num) card_num, a.account_num, a.valid_to, cl.client_id,
                 cl.passport_num passport, cl.passport_valid_to,
                 cl.last_name||' '||cl.first_name||' '||cl.patronymic fio, cl.phone
          FROM fx_cards c JOIN fx_accounts a ON c.account_num=a.account_num
          JOIN fx_clients cl ON a.client=cl.client_id)
"""


def _rules(tx: str, suffix: str, guess_within: str, report_dt: str, owner: str = "owner",
           asof: bool = False, terminals: str = "fx_terminals", blacklist: str = "fx_blacklist") -> str:
    """CTEs r1..r4 over transaction CTE ``tx``; rules 3 and 4 as joins of numbered rows.

    ``asof``: ``owner`` has versions ``[vf, vu)``; the one valid at the event
    time is joined."""
    s = suffix

    def at(t: str) -> str:
        return f" AND o.vf <= {t} AND {t} < o.vu" if asof else ""
    return f"""
r1{s} AS (SELECT t.trans_date event_dt, o.passport, o.fio, o.phone, '1' event_type, {report_dt} report_dt
       FROM {tx} t JOIN {owner} o ON trim(t.card_num)=o.card_num{at("t.trans_date")}
       WHERE t.trans_date >= o.passport_valid_to
          OR o.passport IN (SELECT passport_num FROM {blacklist} b WHERE t.trans_date >= b.entry_dt)),
r2{s} AS (SELECT t.trans_date event_dt, o.passport, o.fio, o.phone, '2' event_type, {report_dt} report_dt
       FROM {tx} t JOIN {owner} o ON trim(t.card_num)=o.card_num{at("t.trans_date")}
       WHERE t.trans_date > o.valid_to),
seen{s} AS (SELECT t.card_num, tr.terminal_city city, t.trans_date happened,
               row_number() OVER (PARTITION BY t.card_num ORDER BY t.trans_date, t.trans_id) k
        FROM {tx} t JOIN {terminals} tr ON tr.terminal_id = t.terminal),
r3{s} AS (SELECT b.happened event_dt, o.passport, o.fio, o.phone, '3' event_type, {report_dt} report_dt
       FROM seen{s} a JOIN seen{s} b ON b.card_num = a.card_num AND b.k = a.k + 1
       JOIN {owner} o ON o.card_num = trim(b.card_num){at("b.happened")}
       WHERE b.city <> a.city AND b.happened <= a.happened + INTERVAL '1 hour'),
ops{s} AS (SELECT card_num, amt, oper_result, trans_date happened,
              row_number() OVER (PARTITION BY card_num ORDER BY trans_date, trans_id) k
       FROM {tx} WHERE oper_type IN ('PAYMENT', 'WITHDRAW')),
chains{s} AS (SELECT hit.card_num, hit.k, hit.happened
       FROM ops{s} hit JOIN ops{s} p ON p.card_num = hit.card_num AND p.k BETWEEN hit.k - 3 AND hit.k - 1
       JOIN ops{s} following ON following.card_num = p.card_num AND following.k = p.k + 1
       WHERE hit.oper_result = 'SUCCESS'
       GROUP BY hit.card_num, hit.k, hit.happened
       HAVING count(*) = 3 AND bool_and(coalesce(p.oper_result = 'REJECT' AND following.amt < p.amt, false))
          AND hit.happened <= min(p.happened) + INTERVAL '{guess_within}'),
r4{s} AS (SELECT c.happened event_dt, o.passport, o.fio, o.phone, '4' event_type, {report_dt} report_dt
       FROM chains{s} c JOIN {owner} o ON o.card_num = trim(c.card_num){at("c.happened")})"""


def _sequential_report(s: str, prior: str | None) -> str:
    """The reference's four anti-inserts, one after another, against ``prior``."""
    base = prior or "(SELECT CAST(NULL AS TIMESTAMP) event_dt, CAST(NULL AS VARCHAR) passport WHERE false)"
    return f"""
rep1{s} AS (SELECT * FROM r1{s} c WHERE NOT EXISTS (SELECT 1 FROM {base} p
            WHERE p.event_dt = c.event_dt AND p.passport = c.passport)),
rep2{s} AS (SELECT * FROM r2{s} c WHERE NOT EXISTS (SELECT 1 FROM (SELECT event_dt, passport FROM {base}
            UNION ALL SELECT event_dt, passport FROM rep1{s}) p
            WHERE p.event_dt = c.event_dt AND p.passport = c.passport)),
rep3{s} AS (SELECT * FROM r3{s} c WHERE NOT EXISTS (SELECT 1 FROM (SELECT event_dt, passport FROM {base}
            UNION ALL SELECT event_dt, passport FROM rep1{s} UNION ALL SELECT event_dt, passport FROM rep2{s}) p
            WHERE p.event_dt = c.event_dt AND p.passport = c.passport)),
rep4{s} AS (SELECT * FROM r4{s} c WHERE NOT EXISTS (SELECT 1 FROM (SELECT event_dt, passport FROM {base}
            UNION ALL SELECT event_dt, passport FROM rep1{s} UNION ALL SELECT event_dt, passport FROM rep2{s}
            UNION ALL SELECT event_dt, passport FROM rep3{s}) p
            WHERE p.event_dt = c.event_dt AND p.passport = c.passport)),
report{s} AS (SELECT * FROM rep1{s} UNION ALL SELECT * FROM rep2{s} UNION ALL SELECT * FROM rep3{s}
              UNION ALL SELECT * FROM rep4{s})"""


REPORT_DT = "DATE '2021-03-01'"
COLS = "event_dt, passport, fio, phone, event_type, report_dt"


def _rule_query(rule: str, within: str = "20 minutes") -> str:
    return f"WITH {FIXTURES}, {_rules('fx_tx_all', '', within, REPORT_DT)} SELECT {COLS} FROM {rule}"


FRAUD_REPORT = (f"WITH {FIXTURES}, {_rules('fx_tx_all', '', '3 days', REPORT_DT)}, "
                f"{_sequential_report('', None)} SELECT {COLS} FROM report")

REPORT_NEXT_DAY = (
    f"WITH {FIXTURES}, fx_tx_cut AS (SELECT * FROM fx_tx_all WHERE trans_date < TIMESTAMP '2024-01-16 00:00:00'), "
    f"{_rules('fx_tx_cut', '_p', '3 days', REPORT_DT)}, {_sequential_report('_p', None)}, "
    f"{_rules('fx_tx_all', '', '3 days', "DATE '2021-03-02'")}, {_sequential_report('', 'report_p')} "
    f"SELECT {COLS} FROM report")

OWNER_AS_OF = """
owner_v AS (SELECT trim(c.card_num) card_num, a.valid_to, cl.passport_num passport, cl.passport_valid_to,
                   cl.last_name||' '||cl.first_name||' '||cl.patronymic fio, v.phone, v.vf, v.vu
            FROM fx_cards c JOIN fx_accounts a ON c.account_num=a.account_num
            JOIN fx_clients cl ON a.client=cl.client_id
            JOIN (SELECT client_id, phone, TIMESTAMP '2024-01-01 00:00:00' vf,
                         CASE WHEN CAST(client_id AS BIGINT)%4=0 THEN TIMESTAMP '2024-01-15 00:00:00'
                              ELSE TIMESTAMP '9999-12-31 00:00:00' END vu FROM fx_clients
                  UNION ALL
                  SELECT client_id, '+8'||client_id, TIMESTAMP '2024-01-15 00:00:00',
                         TIMESTAMP '9999-12-31 00:00:00' FROM fx_clients
                  WHERE CAST(client_id AS BIGINT)%4=0) v ON v.client_id = cl.client_id)"""

FRAUD_REPORT_AS_OF = (f"WITH {FIXTURES}, {OWNER_AS_OF}, "
                      f"{_rules('fx_tx_all', '', '3 days', REPORT_DT, 'owner_v', True)}, "
                      f"{_sequential_report('', None)} SELECT {COLS} FROM report")

OWNER_BRIDGE = f"""WITH {FIXTURES},
bl AS (SELECT passport_num, min(entry_dt) blacklisted_from FROM fx_blacklist GROUP BY passport_num)
SELECT o.card_num, o.account_num, o.valid_to, o.client_id, o.passport, o.passport_valid_to, o.fio, o.phone,
       bl.blacklisted_from
FROM owner o LEFT JOIN bl ON o.passport = bl.passport_num"""

SNAP = """
prev AS (SELECT c_custkey k, c_nationkey a, CASE WHEN c_custkey%6=0 THEN NULL ELSE c_mktsegment END b
         FROM customer WHERE c_custkey%13<>0),
cur AS (SELECT c_custkey k, CASE WHEN c_custkey%5=0 THEN c_nationkey+1 ELSE c_nationkey END a,
               CASE WHEN c_custkey%9=0 THEN NULL ELSE c_mktsegment END b
        FROM customer WHERE c_custkey%17<>0),
j AS (SELECT coalesce(p.k, c.k) k, p.k IS NOT NULL hp, c.k IS NOT NULL hc, p.a pa, p.b pb, c.a ca, c.b cb,
             (p.a IS DISTINCT FROM c.a OR p.b IS DISTINCT FROM c.b) diff
      FROM prev p FULL JOIN cur c ON p.k = c.k),
cls AS (SELECT k, CASE WHEN NOT hp THEN 'new' WHEN NOT hc THEN 'deleted' WHEN diff THEN 'changed'
                       ELSE 'same' END action,
               CASE WHEN hp THEN pa END old_a, CASE WHEN hp THEN pb END old_b,
               CASE WHEN hc THEN ca END new_a, CASE WHEN hc THEN cb END new_b FROM j)"""


def _classify(action: str | None) -> str:
    where = f" WHERE action = '{action}'" if action else ""
    return f"WITH {SNAP} SELECT k, action, old_a, old_b, new_a, new_b FROM cls{where}"


SCD2_MERGE_SNAPSHOT = f"""WITH {SNAP},
run AS (SELECT TIMESTAMP '2024-01-02 02:38:00' t)
SELECT k, pa a, pb b, TIMESTAMP '2024-01-01 00:00:00' effective_from,
       CASE WHEN NOT hc OR diff THEN (SELECT t FROM run) - INTERVAL 1 SECOND END effective_to, 'N' delete_flg
FROM j WHERE hp
UNION ALL
SELECT k, ca, cb, (SELECT t FROM run), NULL, 'N' FROM j WHERE hc AND (NOT hp OR diff)
UNION ALL
SELECT k, pa, pb, (SELECT t FROM run), NULL, 'Y' FROM j WHERE hp AND NOT hc"""

SCD2_MERGE_CDC = """WITH
h AS (SELECT c_custkey k, c_nationkey a FROM customer WHERE c_custkey%13<>0),
ch AS (SELECT c_custkey k, c_nationkey + c_custkey%2 a FROM customer WHERE c_custkey%3=0 AND c_custkey%17<>0),
lv AS (SELECT c_custkey k FROM customer WHERE c_custkey%17<>0),
j AS (SELECT coalesce(h.k, ch.k) k, h.k IS NOT NULL hh, ch.k IS NOT NULL hc, h.a ha, ch.a ca,
             lv.k IS NOT NULL live
      FROM h FULL JOIN ch ON h.k = ch.k LEFT JOIN lv ON lv.k = coalesce(h.k, ch.k)),
s AS (SELECT *, hc AND (NOT hh OR ha IS DISTINCT FROM ca) takes FROM j)
SELECT k c_custkey, ha c_nationkey, TIMESTAMP '2024-01-01 00:00:00' effective_from,
       TIMESTAMP '2024-01-02 10:00:00' - INTERVAL 1 SECOND effective_to, 'N' delete_flg
FROM s WHERE hh AND takes
UNION ALL
SELECT k, CASE WHEN takes THEN ca ELSE ha END,
       CASE WHEN takes THEN TIMESTAMP '2024-01-02 10:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END,
       CASE WHEN NOT live THEN TIMESTAMP '2024-01-03 02:38:00' - INTERVAL 1 SECOND END, 'N'
FROM s WHERE hh OR takes
UNION ALL
SELECT k, CASE WHEN takes THEN ca ELSE ha END, TIMESTAMP '2024-01-03 02:38:00', NULL, 'Y'
FROM s WHERE (hh OR takes) AND NOT live"""

LOG = """
lx AS (SELECT o_custkey, o_orderpriority, o_orderdate, o_orderkey,
              lag(o_orderpriority) OVER w pp, row_number() OVER w rn
       FROM orders WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL
       WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
lv AS (SELECT o_custkey, o_orderpriority, o_orderdate effective_from,
              lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) next_from
       FROM lx WHERE rn = 1 OR pp IS DISTINCT FROM o_orderpriority)"""

SCD2_FROM_LOG = f"""WITH {LOG}
SELECT o_custkey, o_orderpriority, effective_from, next_from - INTERVAL 1 SECOND effective_to, 'N' delete_flg
FROM lv"""

SCD2_CURRENT = f"WITH {LOG} SELECT o_custkey, o_orderpriority, effective_from FROM lv WHERE next_from IS NULL"

SCD2_AS_OF = f"""WITH {LOG},
ev AS (SELECT o_orderkey, o_custkey, o_orderdate - INTERVAL 90 DAY as_of FROM orders)
SELECT ev.o_orderkey, ev.o_custkey, ev.as_of, lv.o_orderpriority, lv.effective_from
FROM ev JOIN lv ON ev.o_custkey = lv.o_custkey AND lv.effective_from <= ev.as_of
 AND (lv.next_from IS NULL OR ev.as_of < lv.next_from)"""

SCD2_FROM_SNAPSHOTS = """WITH
s AS (SELECT o_custkey k, date_trunc('year', o_orderdate) sts, max(o_orderpriority) p
      FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1, 2),
d AS (SELECT sts, row_number() OVER (ORDER BY sts) i, lead(sts) OVER (ORDER BY sts) nsts, count(*) OVER () n
      FROM (SELECT DISTINCT sts FROM s)),
x AS (SELECT s.k, s.p, s.sts, d.i, d.nsts, d.n, lag(d.i) OVER w pi, lead(d.i) OVER w ni, lag(s.p) OVER w pp
      FROM s JOIN d ON s.sts = d.sts WINDOW w AS (PARTITION BY s.k ORDER BY d.i)),
y AS (SELECT *, sum(CASE WHEN i - pi > 1 THEN 1 ELSE 0 END)
               OVER (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) gp FROM x),
r AS (SELECT k, p, sts ef, 'N' fl FROM y WHERE gp = 0 AND (pi IS NULL OR pp IS DISTINCT FROM p)
      UNION ALL
      SELECT k, p, nsts, 'Y' FROM y WHERE gp = 0 AND (ni IS NULL OR ni - i > 1) AND i < n)
SELECT k o_custkey, p o_orderpriority, ef effective_from,
       lead(ef) OVER (PARTITION BY k ORDER BY ef, fl) - INTERVAL 1 SECOND effective_to, fl delete_flg
FROM r"""

FEED = """fd AS (SELECT o_orderkey, o_custkey, o_orderdate create_dt,
                   CASE WHEN o_orderkey%3=0 THEN NULL ELSE o_orderdate + INTERVAL 1 DAY END update_dt FROM orders),
ex AS (SELECT o_orderkey, o_custkey, coalesce(update_dt, create_dt) mod_dt FROM fd
       WHERE (update_dt IS NULL AND create_dt > TIMESTAMP '2000-01-01 00:00:00')
          OR (update_dt IS NOT NULL AND update_dt > TIMESTAMP '2000-01-01 00:00:00'))"""

FEED_PICK = """WITH
days AS (SELECT DISTINCT CAST(ts AS DATE) d FROM events),
kinds(w, x) AS (VALUES ('transactions', '.txt'), ('terminals', '.xlsx'), ('passport_blacklist', '.xlsx')),
files AS (SELECT w || '_' || strftime(d, '%d%m%Y') || x file_name, d FROM days, kinds),
words(feed) AS (VALUES ('transactions'), ('terminals'), ('blacklist'))
SELECT feed, min(file_name) first_by_name, arg_min(file_name, d) first_by_date, min(d) business_date
FROM files JOIN words ON contains(file_name, feed) GROUP BY feed"""

LONG_AMOUNTS = """raw AS (SELECT event_id,
    CASE WHEN event_id%97=0 THEN 'n/a' WHEN event_id%89=0 THEN '1'||repeat('0', 30)||',5'
         WHEN event_id%83=0 THEN NULL
         WHEN event_id%79=0 THEN '7,00000000005'||lpad(CAST(event_id%1000 AS VARCHAR), 3, '0')||'1'
         ELSE CAST(event_id*1000003 AS VARCHAR)||',00'||lpad(CAST(event_id%1000 AS VARCHAR), 3, '0') END amount
    FROM events)"""

DENSE_TX = """fx_tx_dense AS (SELECT trans_id, card_num, oper_type, amt, oper_result, terminal,
    TIMESTAMP '2024-01-01 00:00:00' + to_microseconds(
      (epoch_us(trans_date) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) // 216) trans_date FROM fx_tx_all)"""

# Versions numbered by the changes before them; deletes by the live list.
SCD2_MERGE_LOG = """WITH
e AS (SELECT c_custkey k, '3-MEDIUM' p, TIMESTAMP '1990-01-01 00:00:00' t FROM customer WHERE c_custkey%13<>0
      UNION ALL
      SELECT o_custkey, max(o_orderpriority), o_orderdate FROM orders
      WHERE o_custkey IS NOT NULL AND o_orderdate > TIMESTAMP '1990-01-01 00:00:00' GROUP BY o_custkey, o_orderdate),
s AS (SELECT k, p, t, row_number() OVER (PARTITION BY k ORDER BY t) i FROM e),
v AS (SELECT s.k, s.p, s.t, row_number() OVER (PARTITION BY s.k ORDER BY s.t) i
      FROM s LEFT JOIN s b ON b.k = s.k AND b.i = s.i - 1 WHERE b.k IS NULL OR b.p <> s.p),
w AS (SELECT v.k, v.p, v.t, n.t nt, v.k NOT IN (SELECT c_custkey FROM customer WHERE c_custkey%17<>0) gone
      FROM v LEFT JOIN v n ON n.k = v.k AND n.i = v.i + 1)
SELECT k o_custkey, p o_orderpriority, t effective_from,
       coalesce(nt, CASE WHEN gone THEN TIMESTAMP '2024-01-03 02:38:00' END) - INTERVAL 1 SECOND effective_to,
       'N' delete_flg FROM w
UNION ALL
SELECT k, p, TIMESTAMP '2024-01-03 02:38:00', NULL, 'Y' FROM w WHERE nt IS NULL AND gone"""

# Day 1: the fixtures, transactions and blacklist before their cuts. Day 2: everything, with a fifth of the cards
# at the next account, every 17th card deleted, a quarter of the phones and a third of the terminals changed.
DAY2 = """
fx_tx_cut AS (SELECT * FROM fx_tx_all WHERE trans_date < TIMESTAMP '2024-01-16 00:00:00'),
bl_cut AS (SELECT * FROM fx_blacklist WHERE entry_dt < DATE '2024-01-11'),
term2 AS (SELECT terminal_id, CASE WHEN CAST(substr(terminal_id, 2) AS BIGINT)%3=0 THEN 'Elsewhere'
                                   ELSE terminal_city END terminal_city FROM fx_terminals),
owner2 AS (SELECT 'C'||CAST(k.c_custkey AS VARCHAR) card_num, a.valid_to, cl.passport_num passport,
                  cl.passport_valid_to, cl.last_name||' '||cl.first_name||' '||cl.patronymic fio,
                  CASE WHEN CAST(cl.client_id AS BIGINT)%4=0 THEN '+8'||cl.client_id ELSE cl.phone END phone
           FROM customer k
           JOIN fx_accounts a ON a.account_num = 'A'||CAST(k.c_custkey + CAST(k.c_custkey%5=0 AS INT) AS VARCHAR)
           JOIN fx_clients cl ON a.client = cl.client_id WHERE k.c_custkey%17<>0)"""

DAILY_RUN = (
    f"WITH {FIXTURES}, {DAY2}, "
    f"{_rules('fx_tx_cut', '_p', '3 days', REPORT_DT, blacklist='bl_cut')}, {_sequential_report('_p', None)}, "
    f"{_rules('fx_tx_all', '', '3 days', "DATE '2021-03-02'", 'owner2', terminals='term2')}, "
    f"{_sequential_report('', 'report_p')} "
    f"SELECT {COLS} FROM report_p UNION ALL SELECT {COLS} FROM report")

# The full rescan of both days, every 11th transaction of the first days coming on the second.
REPORT_INCREMENTAL = DAILY_RUN.replace(
    "WHERE trans_date < TIMESTAMP '2024-01-16 00:00:00')",
    "WHERE trans_date < TIMESTAMP '2024-01-16 00:00:00' AND CAST(trans_id AS BIGINT)%11<>0)")

DAILY_RUN_CARDS = """WITH
c AS (SELECT c_custkey k, 'C'||CAST(c_custkey AS VARCHAR)||' ' card_num, c_custkey%17=0 gone,
             c_custkey%5=0 AND c_custkey%17<>0 moved FROM customer)
SELECT card_num, 'A'||CAST(k AS VARCHAR) account_num, TIMESTAMP '2024-01-01 00:00:00' effective_from,
       CASE WHEN moved THEN TIMESTAMP '2024-01-16 09:59:59' WHEN gone THEN TIMESTAMP '2024-01-31 02:37:59' END
         effective_to, 'N' delete_flg FROM c
UNION ALL
SELECT card_num, 'A'||CAST(k + 1 AS VARCHAR), TIMESTAMP '2024-01-16 10:00:00', NULL, 'N' FROM c WHERE moved
UNION ALL
SELECT card_num, 'A'||CAST(k AS VARCHAR), TIMESTAMP '2024-01-31 02:38:00', NULL, 'Y' FROM c WHERE gone"""

DAILY_RUN_CHANGES = """WITH
e AS (SELECT DISTINCT o_custkey k, 'A0' p, TIMESTAMP '1990-01-01 00:00:00' t FROM orders WHERE o_custkey%3<>0
      UNION ALL
      SELECT o_custkey, max('A'||substr(o_orderpriority, 1, 1)), o_orderdate FROM orders
      WHERE o_custkey%3<>0 AND o_custkey%17<>0 AND o_orderdate > TIMESTAMP '1990-01-01 00:00:00' GROUP BY o_custkey, o_orderdate),
s AS (SELECT k, p, t, row_number() OVER (PARTITION BY k ORDER BY t) i FROM e),
v AS (SELECT s.k, s.p, s.t, row_number() OVER (PARTITION BY s.k ORDER BY s.t) i
      FROM s LEFT JOIN s b ON b.k = s.k AND b.i = s.i - 1 WHERE b.k IS NULL OR b.p <> s.p),
w AS (SELECT v.k, v.p, v.t, n.t nt FROM v LEFT JOIN v n ON n.k = v.k AND n.i = v.i + 1)
SELECT 'C'||CAST(k AS VARCHAR) card_num, p account_num, t effective_from,
       coalesce(nt, CASE WHEN k%17=0 THEN TIMESTAMP '2024-01-31 02:38:00' END) - INTERVAL 1 SECOND effective_to, 'N' delete_flg
FROM w
UNION ALL
SELECT 'C'||CAST(k AS VARCHAR), p, TIMESTAMP '2024-01-31 02:38:00', NULL, 'Y' FROM w WHERE nt IS NULL AND k%17=0"""

QUARANTINE_ROWS = f"""WITH {FIXTURES}, {LONG_AMOUNTS},
rough AS (SELECT CASE WHEN r.event_id%67<>0 THEN CAST(r.event_id AS VARCHAR) END transaction_id,
                 CASE WHEN r.event_id%73=0 THEN '31.02.2024' WHEN r.event_id%71=0 THEN ' ' ELSE CAST(e.ts AS VARCHAR) END
                   transaction_date, r.amount
          FROM raw r JOIN events e ON e.event_id = r.event_id),
judged AS (SELECT *, CASE WHEN transaction_id IS NULL THEN 'null_key' WHEN trim(transaction_date) = '' THEN 'null_time'
                          WHEN TRY_CAST(transaction_date AS TIMESTAMP) IS NULL THEN 'unreadable_time'
                          WHEN amount IS NOT NULL AND TRY_CAST(replace(amount, ',', '.') AS DECIMAL(38,10)) IS NULL
                            THEN 'unreadable_amount'
                          WHEN length(rtrim(split_part(amount, ',', 2), '0')) > 10 THEN 'rounded_amount' END reason FROM rough)
SELECT 'transactions' source, reason, transaction_id, transaction_date, amount, CAST(NULL AS VARCHAR) account,
       CAST(NULL AS VARCHAR) entry_dt FROM judged WHERE reason IS NOT NULL
UNION ALL
SELECT 'cards', 'null_key', NULL, NULL, NULL, 'A'||CAST(c_custkey AS VARCHAR), NULL FROM customer WHERE c_custkey%19=0
UNION ALL
SELECT 'blacklist', 'null_key', NULL, NULL, NULL, NULL, CAST(entry_dt AS VARCHAR) FROM fx_blacklist WHERE day(entry_dt)%4=0"""

REPORT_DISTINCT = (f"WITH {FIXTURES}, fx_tx_two AS (SELECT * FROM fx_tx_all UNION ALL SELECT * FROM fx_tx_all), "
                   f"{_rules('fx_tx_two', '', '3 days', REPORT_DT)}, {_sequential_report('', None)} "
                   f"SELECT DISTINCT {COLS} FROM report")

# The previous snapshot again after the current one: what was gone opens again, what was new is gone.
SCD2_REOPEN = f"""WITH {SNAP},
moments AS (SELECT TIMESTAMP '2024-01-01 00:00:00' t0, TIMESTAMP '2024-01-02 02:38:00' t1, TIMESTAMP '2024-01-31 02:38:00' t2),
r AS (SELECT k, pa a, pb b, t0 effective_from, CASE WHEN NOT hc OR diff THEN t1 - INTERVAL 1 SECOND END effective_to,
             'N' delete_flg FROM j, moments WHERE hp
      UNION ALL SELECT k, ca, cb, t1, t2 - INTERVAL 1 SECOND, 'N' FROM j, moments WHERE hc AND (NOT hp OR diff)
      UNION ALL SELECT k, pa, pb, t1, t2 - INTERVAL 1 SECOND, 'Y' FROM j, moments WHERE hp AND NOT hc
      UNION ALL SELECT k, pa, pb, t2, NULL, 'N' FROM j, moments WHERE hp AND (NOT hc OR diff)
      UNION ALL SELECT k, ca, cb, t2, NULL, 'Y' FROM j, moments WHERE NOT hp AND hc)
SELECT * FROM r"""

ORACLE_SQL: dict[str, str] = {
    "fraud_report": FRAUD_REPORT,
    "report_next_day": REPORT_NEXT_DAY,
    "fraud_report_as_of": FRAUD_REPORT_AS_OF,
    "rule_passport": _rule_query("r1"),
    "rule_account": _rule_query("r2"),
    "rule_cities": _rule_query("r3"),
    "rule_guessing": _rule_query("r4", "20 minutes"),
    "rule_guessing_1d": _rule_query("r4", "1 day"),
    "rule_guessing_3d": _rule_query("r4", "3 days"),
    "owner_bridge": OWNER_BRIDGE,
    "scd2_classify": _classify(None),
    "scd2_new": _classify("new"),
    "scd2_changed": _classify("changed"),
    "scd2_deleted": _classify("deleted"),
    "scd2_merge_snapshot": SCD2_MERGE_SNAPSHOT,
    "scd2_merge_cdc": SCD2_MERGE_CDC,
    "scd2_from_log": SCD2_FROM_LOG,
    "scd2_current": SCD2_CURRENT,
    "scd2_as_of": SCD2_AS_OF,
    "scd2_from_snapshots": SCD2_FROM_SNAPSHOTS,
    "not_in_null_aware": """SELECT c_custkey FROM customer WHERE c_custkey NOT IN
        (SELECT CASE WHEN c_custkey%2=0 THEN c_custkey END FROM customer)""",
    "not_in_plain": """SELECT c_custkey FROM customer WHERE c_custkey NOT IN
        (SELECT c_custkey FROM customer WHERE c_custkey%2=0)""",
    "anti_keys": """SELECT c_custkey FROM customer c WHERE NOT EXISTS
        (SELECT 1 FROM customer r WHERE r.c_custkey%2=0 AND r.c_custkey = c.c_custkey)""",
    "extract_increment": f"WITH {FEED} SELECT o_orderkey, o_custkey, mod_dt FROM ex",
    "watermark_advance": f"""WITH {FEED}
        SELECT coalesce(max(mod_dt), TIMESTAMP '2000-01-01 00:00:00') max_update_dt FROM ex""",
    "live_keys": "SELECT o_orderkey FROM orders",
    "transactions_clean": f"""WITH {FIXTURES}
        SELECT trans_id, trans_date, card_num, oper_type, CAST(amt AS DECIMAL(38,10)) amt, oper_result, terminal
        FROM fx_tx_all""",
    "amounts_exact": f"""WITH {LONG_AMOUNTS}
        SELECT CAST(event_id AS VARCHAR) trans_id,
               CAST(TRY_CAST(replace(amount, ',', '.') AS DECIMAL(38,10)) AS VARCHAR) amt FROM raw""",
    "amounts_audit": f"""WITH {LONG_AMOUNTS}
        SELECT count(*) n_rows, count(*) FILTER (amount IS NULL) n_missing,
               count(*) FILTER (amount IS NOT NULL AND TRY_CAST(replace(amount, ',', '.') AS DECIMAL(38,10)) IS NULL)
                 n_unreadable,
               count(*) FILTER (length(rtrim(split_part(amount, ',', 2), '0')) > 10) n_rounded FROM raw""",
    "rule_guessing_dense": f"""WITH {FIXTURES}, {DENSE_TX},
        {_rules('fx_tx_dense', '', '20 minutes', REPORT_DT)} SELECT {COLS} FROM r4""",
    "not_in_left_nulls": """WITH l AS (SELECT c_custkey, CASE WHEN c_custkey%3<>0 THEN c_custkey END k FROM customer)
        SELECT c_custkey, k FROM l WHERE k NOT IN (SELECT c_custkey FROM customer WHERE c_custkey%2=0)""",
    "scd2_merge_log": SCD2_MERGE_LOG,
    "daily_run": DAILY_RUN,
    "report_incremental": REPORT_INCREMENTAL,
    "daily_run_cards": DAILY_RUN_CARDS,
    "daily_run_changes": DAILY_RUN_CHANGES,
    "quarantine_rows": QUARANTINE_ROWS,
    "append_unique": f"""WITH {FIXTURES}
        SELECT trans_id, trans_date, card_num, oper_type, CAST(amt AS DECIMAL(38,10)) amt, oper_result, terminal
        FROM fx_tx_all""",
    "terminals_sheet": f"WITH {FIXTURES} SELECT terminal_id, terminal_type, terminal_city, terminal_address FROM fx_terminals",
    "blacklist_sheet": f"WITH {FIXTURES} SELECT entry_dt, passport_num FROM fx_blacklist",
    "transactions_pattern": f"""WITH {FIXTURES}
        SELECT trans_id, date_trunc('second', trans_date) trans_date, card_num, oper_type, CAST(amt AS DECIMAL(38,10)) amt,
               oper_result, terminal FROM fx_tx_all""",
    "report_distinct": REPORT_DISTINCT,
    "scd2_reopen": SCD2_REOPEN,
    "feed_pick": FEED_PICK,
    "blacklist_append": f"""WITH {FIXTURES}
        SELECT passport_num, min(entry_dt) entry_dt FROM fx_blacklist b
        WHERE passport_num NOT IN (SELECT passport_num FROM fx_blacklist WHERE entry_dt < DATE '2024-01-11')
        GROUP BY passport_num""",
}
