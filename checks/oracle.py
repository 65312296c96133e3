"""Independent SQL for the registered queries, for DuckDB over the same tables.

Each statement starts with the tables the ledger is derived from, written here
in SQL, and then answers the query with joins, window functions and unions.
"""

from __future__ import annotations

import re

START, END = "1996-01-01T00:00:00", "1998-12-31T00:00:00"
FSP_ID, PARTICIPANT_ID = "NATION_3", 100
WINDOW_ID, RECONCILED_WINDOW_ID = 23957, 23955
TIMEOUT_AS_OF = "2001-07-01T00:00:00"

LEDGER = """
fx_currency(r, currencyId) AS (VALUES (0,'XOF'),(1,'XTS'),(2,'XXX'),(3,'EUR'),(4,'MAD')),
paid AS (
  SELECT l_orderkey, min(l_suppkey) AS supp, CAST(max(l_extendedprice) AS DECIMAL(18,4)) AS amt
  FROM lineitem GROUP BY l_orderkey),
base AS MATERIALIZED (
  SELECT o_orderkey AS k, o_orderdate + to_seconds(o_orderkey % 86400) + to_milliseconds(o_orderkey % 1000) AS ts,
    o_orderstatus AS st, o_orderpriority AS pri, cn.n_nationkey AS pn, sn.n_nationkey AS en, cn.n_name AS pname,
    sn.n_name AS ename, cn.n_regionkey AS pr, sn.n_regionkey AS er, c_name AS payerParty, s_name AS payeeParty, amt
  FROM orders JOIN paid ON l_orderkey = o_orderkey
  JOIN customer ON c_custkey = o_custkey JOIN nation cn ON cn.n_nationkey = c_nationkey
  JOIN supplier ON s_suppkey = supp JOIN nation sn ON sn.n_nationkey = s_nationkey),
leg AS MATERIALIZED (
  SELECT *, 0 AS leg, 'D' || k AS transferId, 'QD' || k AS quoteId, pn + 1 AS payerPid, en + 1 AS payeePid, pr AS cur
  FROM base WHERE pr = er
  UNION ALL SELECT *, 1, 'A' || k, 'QA' || k, pn + 1, 100 + pr, pr FROM base WHERE pr <> er
  UNION ALL SELECT *, 2, 'B' || k, 'QB' || k, 100 + er, en + 1, er FROM base WHERE pr <> er AND pri <> '5-LOW'),
participant AS (
  SELECT n_nationkey + 1 AS participantId, n_name AS name FROM nation
  UNION ALL SELECT 100 + r, 'DFSP' || currencyId FROM fx_currency),
account AS (
  SELECT 1001 + n_nationkey AS accountId, n_nationkey + 1 AS participantId, currencyId
  FROM nation JOIN fx_currency ON r = n_regionkey
  UNION ALL SELECT 1100 + r, 100 + r, currencyId FROM fx_currency),
owner AS (SELECT accountId, participantId, name, currencyId FROM account JOIN participant USING (participantId)),
transfer AS (SELECT transferId, amt AS amount, currencyId, ts AS createdDate FROM leg JOIN fx_currency ON r = cur),
line AS (
  SELECT k * 8 + leg * 2 AS lineId, transferId, 1000 + payerPid AS accountId, 'PAYER_DFSP' AS role, amt AS amount FROM leg
  UNION ALL SELECT k * 8 + leg * 2 + 1, transferId, 1000 + payeePid, 'PAYEE_DFSP', -amt FROM leg),
pair AS (
  SELECT f.transferId, f.lineId AS payerLineId, f.accountId AS payerAccountId, f.amount AS payerAmount,
    t.lineId AS payeeLineId, t.accountId AS payeeAccountId
  FROM line f JOIN line t ON f.transferId = t.transferId AND f.lineId <> t.lineId WHERE f.role = 'PAYER_DFSP'),
quote AS (
  SELECT quoteId, transferId, ts - INTERVAL 5 SECOND AS createdDate,
    CASE WHEN pri = '1-URGENT' THEN 'Reversal' ELSE 'Original' END AS nature,
    CASE WHEN k % 5 <> 0 THEN 'P2P' END AS type FROM leg),
quoteParty AS (
  SELECT quoteId, 'PAYER' AS kind, 'PAYER_DFSP' AS role, pname AS fspId, payerParty AS identifier, currencyId, amt AS amount
  FROM leg JOIN fx_currency ON r = cur
  UNION ALL SELECT quoteId, 'PAYEE', 'PAYEE_DFSP', ename, payeeParty, currencyId, -amt
  FROM leg JOIN fx_currency ON r = cur),
response AS (
  SELECT quoteId, s.currencyId AS sentCurrency, amt AS sent, CASE WHEN leg = 1 THEN d.currencyId END AS receivedCurrency,
    CASE WHEN leg = 1 THEN CAST(amt * 2 AS DECIMAL(18,4)) END AS received
  FROM leg JOIN fx_currency s ON s.r = cur JOIN fx_currency d ON d.r = er),
exchange AS (
  SELECT 'A' || k AS a, 'B' || k AS b, 'QA' || k AS qa, 'FX' || k AS qb, pr * 5 + er AS rateId,
    'DFSP' || currencyId AS sourceFSP FROM leg JOIN fx_currency ON r = er WHERE leg = 2),
rate AS (
  SELECT s.r * 5 + d.r AS rateId, (s.r + 1) * 1250 + d.r * 375 AS rate, s.currencyId AS src, d.currencyId AS dst,
    CASE WHEN (s.r * 5 + d.r) % 2 = 0 THEN 7000 + s.r * 5 + d.r END AS rateSetId
  FROM fx_currency s JOIN fx_currency d ON s.r <> d.r),
state AS (
  SELECT (k * 10 + 1) * 3 + leg AS id, transferId, 'RECEIVED_PREPARE' AS state, ts AS createdDate FROM leg
  UNION ALL SELECT (k * 10 + 2) * 3 + leg, transferId, 'RESERVED', ts + INTERVAL 1 SECOND FROM leg WHERE st <> 'O'
  UNION ALL SELECT (k * 10 + 3) * 3 + leg, transferId, 'COMMITTED', ts + INTERVAL 2 SECOND FROM leg WHERE st = 'F'
  UNION ALL SELECT (k * 10 + 3) * 3 + leg, transferId, 'ABORTED_ERROR', ts + INTERVAL 2 SECOND FROM leg
    WHERE st = 'O' AND k % 7 = 0),
latest AS (
  SELECT transferId, state, createdDate FROM state
  QUALIFY row_number() OVER (PARTITION BY transferId ORDER BY id DESC) = 1),
shown AS (
  SELECT transferId, state, createdDate, replace(state, '_ERROR', '') AS word FROM latest
  WHERE state <> 'RECEIVED_PREPARE'),
error AS (SELECT transferId, '4001' AS code FROM leg WHERE st = 'O' AND k % 7 = 0),
fulfilment AS (
  SELECT transferId, CASE WHEN k % 11 <> 0 THEN year(ts) * 12 + month(ts) END AS w FROM leg WHERE st = 'F'),
win AS (SELECT DISTINCT year(ts) * 12 + month(ts) AS w, date_trunc('month', ts) AS m FROM leg),
settlement AS (
  SELECT w, CASE WHEN (w // 3) % 2 = 0 THEN 'SETTLED' ELSE 'PENDING_SETTLEMENT' END AS state,
    TIMESTAMP '2001-12-01 00:00:00' AS moment FROM win WHERE w < 24018),
opened AS (SELECT w, CAST(m AS TIMESTAMP) AS moment FROM win),
closed AS (SELECT w, CAST(m + INTERVAL 1 MONTH AS TIMESTAMP) AS moment FROM win WHERE w < 24018),
fulfilled AS (
  SELECT f.transferId, f.w, s.state, s.moment FROM fulfilment f LEFT JOIN settlement s ON s.w = f.w)
"""


def iso(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"


def word(value: str) -> str:
    return f"coalesce(CAST({value} AS VARCHAR), 'null')"


def plain(value: str) -> str:
    return f"rtrim(rtrim(CAST({value} AS VARCHAR), '0'), '.')"


def float8(value: str) -> str:
    return plain(f"CAST({value} AS DECIMAL(38,8))")


def _definitions(text: str) -> dict[str, str]:
    """Each table's definition by name; a definition starts at the start of a line."""
    parts = re.split(r"(?m)^(?=\w+(?:\([\w, ]+\))? AS (?:MATERIALIZED )?\()", text)
    return {re.match(r"\w+", p)[0]: p.strip().rstrip(",") for p in parts if p.strip()}


def statement(select: str, *tables: str) -> str:
    """The query after the tables it needs, directly or through others."""
    wanted, kept = select, []
    for name, text in reversed(_definitions("\n".join([LEDGER, *tables])).items()):
        if re.search(rf"(?:FROM|JOIN|,)\s+{name}\b", wanted):
            wanted += "\n" + text
            kept.insert(0, text)
    return "WITH " + ",\n".join(kept) + "\n" + select.strip()


BETWEEN = f"q.createdDate BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'"
DETAILS = f"""
details AS (
  SELECT transferId, CASE WHEN state = 'SETTLED' THEN {iso('moment')} ELSE 'null' END AS settlementDate,
    {word('w')} AS settlementWindowId, {word('state')} AS settlementState, {word(iso('moment'))} AS settlementStateChangeDate
  FROM fulfilled)
"""
QUOTED = f"""
quoted AS (
  SELECT q.quoteId, q.transferId, q.type, q.nature, q.createdDate AS quotedAt, t.createdDate AS transferredAt, t.amount,
    sp.fspId AS senderFsp, rp.fspId AS receiverFsp, sp.identifier AS senderParty, rp.identifier AS receiverParty,
    po.name AS payer, ro.name AS payee, po.currencyId AS payerCurrency, ro.currencyId AS payeeCurrency
  FROM quote q JOIN transfer t ON t.transferId = q.transferId JOIN pair p ON p.transferId = t.transferId
  JOIN owner po ON po.accountId = p.payerAccountId JOIN owner ro ON ro.accountId = p.payeeAccountId
  JOIN quoteParty sp ON sp.quoteId = q.quoteId AND sp.kind = 'PAYER'
  JOIN quoteParty rp ON rp.quoteId = q.quoteId AND rp.kind = 'PAYEE'
  WHERE {BETWEEN})
"""


def _core_columns() -> str:
    return f"""
    x.quoteId, x.senderFsp AS senderDFSPName, x.receiverFsp AS receiverDFSPName, x.transferId AS currentHubTransferID,
    x.type AS transactionType, x.nature AS natureOfTxnType, {iso('x.quotedAt')} AS requestDate,
    {iso('x.transferredAt')} AS createdDate, x.senderParty AS senderId, x.receiverParty AS receiverId,
    'RNND' AS receiverNameStatus, 'null' AS pricingOption, 'null' AS receiverKYCLevelStatus,
    {word('e.code')} AS errorCode, x.transferId AS senderDFSPTxnID, x.transferId AS receiverDFSPTxnID"""


# Which exchange a transfer belongs to and as which leg: the first leg wins.
DFSP_CORE = f"""
dfspCore AS (
  SELECT {_core_columns()},
    CASE WHEN fa.a IS NOT NULL THEN fa.a WHEN fb.a IS NOT NULL THEN fb.a ELSE 'null' END AS parentTransferID,
    CASE WHEN fa.b IS NOT NULL THEN fa.b WHEN fb.a IS NOT NULL THEN fb.a ELSE 'null' END AS reciprocalHubTransferID,
    CASE WHEN fa.rateId IS NOT NULL THEN fa.rateId ELSE fb.rateId END AS exchangeRateId,
    fa.qa AS legAQuoteAId, fb.qa AS legBQuoteAId,
    CASE WHEN fa.a IS NOT NULL THEN fa.a ELSE fb.a END AS legATransferId,
    CASE WHEN fa.b IS NOT NULL THEN fa.b ELSE fb.b END AS legBTransferId
  FROM quoted x LEFT JOIN error e ON e.transferId = x.transferId
  LEFT JOIN exchange fa ON fa.a = x.transferId LEFT JOIN exchange fb ON fb.b = x.transferId
  WHERE '{FSP_ID}' IN (x.payer, x.payee))
"""
HUB_CORE = f"""
hubCore AS (
  SELECT {_core_columns()}, {word('x.payee')} AS leg1vDFSP, {word('fq.sourceFSP')} AS leg2vDFSP,
    {word('fa.a')} AS parentTransferID, {word('fa.b')} AS reciprocalHubTransferID, fa.rateId AS exchangeRateId,
    fa.qa AS legAQuoteAId, fa.qb AS legBQuoteAId, fa.a AS legATransferId, fa.b AS legBTransferId
  FROM quoted x LEFT JOIN error e ON e.transferId = x.transferId LEFT JOIN exchange fa ON fa.a = x.transferId
  LEFT JOIN exchange fq ON fq.qb = fa.qb
  WHERE x.payee <> x.receiverFsp)
"""


def _report(core: str, columns: str, receiver_currency: str, receiver_status: str, identifiers: bool = True) -> str:
    parties = "c.senderId, c.receiverId," if identifiers else ""
    rate = "(g.rate / pow(10, 3))"
    rounding = f"(p.sent * {rate} - p.received)"
    # A state belongs to leg A, or to the transfer itself where there is no leg A.
    return f"""
SELECT DISTINCT {columns} c.transactionType, c.natureOfTxnType, c.requestDate, c.createdDate,
  {word('da.settlementDate')} AS settlementDate, p.sentCurrency AS senderCurrency,
  {receiver_currency} AS receiverCurrency, {parties}
  {plain('p.sent')} AS senderAmount,
  {plain('CASE WHEN p.received IS NULL THEN p.sent ELSE p.received END')} AS receiverAmount,
  {word(float8(rate))} AS forexRate, {word('g.rateSetId')} AS fxRateSetID, {word(float8(rounding))} AS rounding,
  c.receiverNameStatus, c.pricingOption, c.receiverKYCLevelStatus, {word('sa.word')} AS senderTxStatus,
  {receiver_status} AS receiverTxStatus, {iso('sa.createdDate')} AS modificationDate, c.errorCode, c.senderDFSPTxnID,
  c.receiverDFSPTxnID, {word('da.settlementWindowId')} AS senderSettlementWindowId,
  {word('db.settlementWindowId')} AS receiverSettlementWindowId, {word('da.settlementState')} AS settlementState,
  {word('da.settlementStateChangeDate')} AS settlementStateChangeDate
FROM {core} c
LEFT JOIN response p ON p.quoteId = CASE WHEN c.legAQuoteAId IS NOT NULL THEN c.legAQuoteAId
  WHEN c.legBQuoteAId IS NOT NULL THEN c.legBQuoteAId ELSE c.quoteId END
LEFT JOIN rate g ON g.rateId = c.exchangeRateId
LEFT JOIN shown sa ON sa.transferId = c.legATransferId
  OR (c.legATransferId IS NULL AND sa.transferId = c.currentHubTransferID)
LEFT JOIN shown sb ON sb.transferId = c.legBTransferId
LEFT JOIN details da ON da.transferId = c.legATransferId
LEFT JOIN details db ON db.transferId = c.legBTransferId"""


_HUB_COLUMNS = """c.senderDFSPName, c.leg1vDFSP, c.leg2vDFSP, c.receiverDFSPName,
  c.currentHubTransferID AS senderTransferID, c.parentTransferID, c.reciprocalHubTransferID AS receiverTransferID,"""
_DFSP_COLUMNS = """c.senderDFSPName, c.receiverDFSPName, c.currentHubTransferID AS currentTransferID,
  c.parentTransferID, c.reciprocalHubTransferID AS reciprocalTransferID,"""

SETTLEMENT_WINDOW = """
SELECT p.fspId, CAST(f.w AS BIGINT) AS settlementWindowId, CASE WHEN c.w IS NULL THEN 'OPEN' ELSE 'CLOSED' END AS state,
  count(p.amount) AS numTransactions, sum(p.amount) AS netPosition, o.moment AS windowOpen, c.moment AS windowClose
FROM fulfilment f JOIN line l ON l.transferId = f.transferId JOIN quote q ON q.transferId = f.transferId
LEFT JOIN quoteParty p ON p.quoteId = q.quoteId AND p.role = l.role
JOIN opened o ON o.w = f.w LEFT JOIN closed c ON c.w = f.w
GROUP BY ALL"""


def _reconciliation(condition: str) -> str:
    return f"""
SELECT DISTINCT q.quoteId, po.name AS senderDFSPId, po.name AS senderDFSPName, rp.fspId AS receiverDFSPId,
  ro.name AS receiverDFSPName, t.transferId AS hubTxnID, q.type AS transactionType, q.nature AS natureOfTxnType,
  q.createdDate AS requestDate, t.createdDate AS createdDate, CASE WHEN f.state = 'SETTLED' THEN f.moment END AS settlementDate,
  sp.currencyId AS senderCountryCurrencyCode, rp.currencyId AS receiverCountryCurrencyCode, sp.identifier AS senderId,
  rp.identifier AS receiverId, t.amount AS reconciliationAmount, 'RNND' AS receiverNameStatus, '' AS pricingOption,
  '' AS receiverKYCLevelStatus, s.state AS status, s.createdDate AS modificationDate, '' AS errorCode,
  t.transferId AS senderDFSPTxnID, t.transferId AS receiverDFSPTxnID,
  coalesce(CAST(f.w AS VARCHAR), '') AS settlementWindowId, f.state AS settlementState, f.moment AS settlementStateChangeDate
FROM quote q JOIN transfer t ON t.transferId = q.transferId JOIN response p ON p.quoteId = q.quoteId
JOIN quoteParty sp ON sp.quoteId = q.quoteId AND sp.kind = 'PAYER' JOIN participant po ON po.name = sp.fspId
JOIN quoteParty rp ON rp.quoteId = q.quoteId AND rp.kind = 'PAYEE' JOIN participant ro ON ro.name = rp.fspId
LEFT JOIN fulfilled f ON f.transferId = t.transferId LEFT JOIN latest s ON s.transferId = t.transferId
WHERE {BETWEEN} AND {condition}"""


_OWN = f"'{FSP_ID}' IN (po.name, ro.name)"

RECONCILIATION_AMOUNT = f"""
SELECT po.name AS fromName, po.participantId AS fromId, ro.name AS toName, ro.participantId AS toId,
  po.currencyId AS currency, count(*) AS numTransactions,
  {plain(f'sum(CASE WHEN po.participantId = {PARTICIPANT_ID} THEN payerAmount ELSE 0 END)')} AS sent,
  {plain(f'sum(CASE WHEN po.participantId = {PARTICIPANT_ID} THEN 0 ELSE payerAmount END)')} AS received,
  {plain(f'sum(CASE WHEN po.participantId = {PARTICIPANT_ID} THEN -payerAmount ELSE payerAmount END)')} AS net,
  o.moment AS settlementWindowOpen, c.moment AS settlementWindowClose
FROM pair p JOIN fulfilment f ON f.transferId = p.transferId
JOIN owner po ON po.accountId = payerAccountId JOIN owner ro ON ro.accountId = payeeAccountId
JOIN opened o ON o.w = f.w JOIN closed c ON c.w = f.w
WHERE f.w = {WINDOW_ID} AND {PARTICIPANT_ID} IN (po.participantId, ro.participantId)
GROUP BY po.name, po.participantId, ro.name, ro.participantId, po.currencyId, o.moment, c.moment"""

DFSP_LEGACY = f"""
SELECT x.quoteId, x.payer AS senderDFSPId, x.payer AS senderDFSPName, x.payee AS receiverDFSPId,
  x.payee AS receiverDFSPName, x.transferId AS currentHubTransferID,
  {word('CASE WHEN fa.a IS NOT NULL THEN fa.a ELSE fb.a END')} AS parentTransferID,
  {word('CASE WHEN fa.b IS NOT NULL THEN fa.b ELSE fb.a END')} AS reciprocalHubTransferID,
  x.type AS transactionType, x.nature AS natureOfTxnType, {iso('x.quotedAt')} AS requestDate,
  {iso('x.transferredAt')} AS createdDate, {word('d.settlementDate')} AS settlementDate,
  x.payerCurrency AS senderCountryCurrencyCode, x.payeeCurrency AS receiverCountryCurrencyCode,
  x.senderParty AS senderId, x.receiverParty AS receiverId, {plain('x.amount')} AS reconciliationAmount,
  'RNND' AS receiverNameStatus, 'null' AS pricingOption, 'null' AS receiverKYCLevelStatus, s.word AS status,
  {iso('s.createdDate')} AS modificationDate, 'null' AS errorCode, x.transferId AS senderDFSPTxnID,
  x.transferId AS receiverDFSPTxnID, {word('d.settlementWindowId')} AS settlementWindowId,
  {word('d.settlementState')} AS settlementState, {word('d.settlementStateChangeDate')} AS settlementStateChangeDate
FROM quoted x LEFT JOIN details d ON d.transferId = x.transferId LEFT JOIN shown s ON s.transferId = x.transferId
LEFT JOIN exchange fa ON fa.a = x.transferId LEFT JOIN exchange fb ON fb.b = x.transferId
WHERE '{FSP_ID}' IN (x.payer, x.payee)"""

# The quote facts as plain columns instead of JSON, and the rules over them.
FACTS = """
altered AS (
  SELECT *, CASE WHEN k % 19 = 0 THEN (k // 19) % 10 END AS bad,
    CASE WHEN k % 19 <> 0 AND k % 17 = 0 THEN (k // 17) % 6 END AS rt,
    CASE WHEN k % 19 <> 0 AND k % 17 <> 0 AND k % 13 = 0 THEN (k // 13) % 5 END AS rare,
    k % 19 <> 0 AND k % 17 <> 0 AND k % 13 <> 0 AND k % 11 = 0 AS internal
  FROM leg WHERE leg < 2),
route(rt, src, dst, kind, money, fromMoney, toMoney, ruleNo) AS (VALUES
  (0, 'testfsp5', 'testfsp4', 'SEND', 'XOF', 'XOF', 'MAD', 4), (1, 'testfsp5', 'testfsp4', 'RECEIVE', 'MAD', 'XOF', 'MAD', 5),
  (2, 'testfsp5', 'testfsp6', 'SEND', 'UGX', 'UGX', 'ZMW', 11), (3, 'testfsp5', 'testfsp6', 'RECEIVE', 'ZMW', 'UGX', 'ZMW', 12),
  (4, 'testfsp6', 'testfsp5', 'SEND', 'ZMW', 'ZMW', 'UGX', 13), (5, 'testfsp6', 'testfsp5', 'RECEIVE', 'UGX', 'ZMW', 'UGX', 14)),
rarePair(rare, f, t) AS (VALUES (0, 'EUR', 'GHS'), (1, 'UGX', 'RWF'), (2, 'RWF', 'UGX'), (3, 'ZMW', 'RWF'), (4, 'RWF', 'ZMW')),
sided AS (
  SELECT a.*, coalesce(x.f, s.currencyId) AS payerMoney, coalesce(x.t, d.currencyId) AS payeeMoney,
    coalesce(o.src, CASE WHEN internal THEN 'DFSP' || s.currencyId ELSE pname END) AS src, coalesce(o.dst, ename) AS dst,
    CASE WHEN bad = 2 THEN 'SEND' WHEN bad = 3 THEN 'RECEIVE' WHEN o.kind IS NOT NULL THEN o.kind
      WHEN k % 2 = 0 THEN 'SEND' ELSE 'RECEIVE' END AS kind, o.money
  FROM altered a JOIN fx_currency s ON s.r = a.pr JOIN fx_currency d ON d.r = a.er
  LEFT JOIN route o ON o.rt = a.rt LEFT JOIN rarePair x ON x.rare = a.rare),
fact AS (
  SELECT quoteId, src, dst, kind, CASE WHEN bad IN (2, 3) THEN 'ZZZ' WHEN money IS NOT NULL THEN money
      WHEN kind = 'SEND' THEN payerMoney ELSE payeeMoney END AS money,
    CASE WHEN bad IS DISTINCT FROM 0 THEN payerMoney END AS payerHas,
    CASE WHEN bad IS DISTINCT FROM 1 THEN payeeMoney END AS payeeHas,
    CASE WHEN bad = 4 THEN 'OTHERFSP' ELSE src END AS payloadFsp,
    bad IS DISTINCT FROM 5 AS hasInfo, coalesce(bad NOT IN (5, 6), true) AS hasFirst, coalesce(bad NOT IN (5, 7), true) AS hasLast,
    CASE WHEN bad IN (5, 8) THEN NULL WHEN bad = 9 THEN '' ELSE '1990-01-01' END AS born,
    src IN ('DFSPEUR','DFSPMAD','DFSPUGX','DFSPZMW','DFSPRWF','DFSPGHS','DFSPXOF','DFSPXTS','DFSPXXX') AS fromHub
  FROM sided),
checked AS (
  SELECT *, money IS DISTINCT FROM payerHas OR money IS DISTINCT FROM payeeHas AS foreignMoney FROM fact),
invalid AS (
  SELECT quoteId, 0 AS ruleNo, 'PAYER_ERROR' AS FSPIOPError, 'Payer does not have any active account' AS message
  FROM checked WHERE payerHas IS NULL
  UNION ALL SELECT quoteId, 1, 'PAYEE_ERROR', 'Payee does not have any active accounts' FROM checked WHERE payeeHas IS NULL
  UNION ALL SELECT quoteId, 21, 'PAYER_UNSUPPORTED_CURRENCY', 'Requested currency not available for payer'
    FROM checked WHERE kind = 'SEND' AND money IS DISTINCT FROM payerHas
  UNION ALL SELECT quoteId, 22, 'PAYEE_UNSUPPORTED_CURRENCY', 'Requested currency not available for payee'
    FROM checked WHERE kind = 'RECEIVE' AND money IS DISTINCT FROM payeeHas
  UNION ALL SELECT quoteId, 23, 'VALIDATION_ERROR', 'The payer FSP does not match the fspiop-source header'
    FROM checked WHERE foreignMoney AND NOT fromHub AND src <> payloadFsp
  UNION ALL SELECT quoteId, 24, 'MISSING_ELEMENT', 'PartyPersonalInfo is required' FROM checked WHERE foreignMoney AND NOT hasInfo
  UNION ALL SELECT quoteId, 25, 'MISSING_ELEMENT', 'firstName is required' FROM checked WHERE foreignMoney AND NOT hasFirst
  UNION ALL SELECT quoteId, 26, 'MISSING_ELEMENT', 'lastName is required' FROM checked WHERE foreignMoney AND NOT hasLast
  UNION ALL SELECT quoteId, 27, 'MISSING_ELEMENT', 'dateOfBirth is required' FROM checked WHERE foreignMoney AND born IS NULL
  UNION ALL SELECT quoteId, 28, 'MALFORMED_SYNTAX', 'Malformed Payer dateOfBirth' FROM checked WHERE foreignMoney AND born = ''),
accountRoute(ruleNo, f, t) AS (VALUES (2, 'MAD', 'EUR'), (3, 'XOF', 'MAD'), (6, 'MAD', 'XOF'), (7, 'XOF', 'EUR'),
  (8, 'EUR', 'XOF'), (9, 'EUR', 'MAD'), (10, 'EUR', 'GHS'), (15, 'UGX', 'RWF'), (16, 'RWF', 'UGX'), (17, 'ZMW', 'RWF'),
  (18, 'RWF', 'ZMW'), (19, 'XTS', 'XXX'), (20, 'XXX', 'XTS')),
byAccount AS (
  SELECT quoteId, ruleNo, 'DFSP' || f AS rerouteToFsp, f AS sourceCurrency, t AS rerouteToFspCurrency
  FROM fact JOIN accountRoute ON f = payerHas AND t = payeeHas
  WHERE NOT fromHub AND NOT (ruleNo = 3 AND src = 'testfsp5')),
byRoute AS (
  SELECT quoteId, ruleNo, 'DFSP' || fromMoney AS rerouteToFsp, fromMoney AS sourceCurrency, toMoney AS rerouteToFspCurrency
  FROM fact q JOIN route o ON q.src = o.src AND q.dst = o.dst AND q.kind = o.kind AND q.money = o.money)
"""
EVENTS = """
SELECT quoteId, ruleNo, 'INVALID_QUOTE_REQUEST' AS eventType, FSPIOPError, message, NULL AS rerouteToFsp,
  NULL AS sourceCurrency, NULL AS rerouteToFspCurrency FROM invalid
UNION ALL SELECT quoteId, ruleNo, 'INTERCEPT_QUOTE', NULL, NULL, rerouteToFsp, sourceCurrency, rerouteToFspCurrency FROM byAccount
UNION ALL SELECT quoteId, ruleNo, 'INTERCEPT_QUOTE', NULL, NULL, rerouteToFsp, sourceCurrency, rerouteToFspCurrency FROM byRoute"""

PAYMENTS = """
payment AS (
  SELECT e.a AS transferAId, e.b AS transferBId, x.currencyId AS sourceCurrency, y.currencyId AS targetCurrency, x.amount,
    x.createdDate FROM exchange e JOIN transfer x ON x.transferId = e.a JOIN transfer y ON y.transferId = e.b),
validity AS (
  SELECT CAST(w * 25 + rateId AS BIGINT) AS rateId, src, dst, (rate + w % 7) / pow(10, 3) AS rateValue, CAST(m AS TIMESTAMP) AS validFrom,
    CAST(m + INTERVAL 1 MONTH AS TIMESTAMP) AS validTo FROM win, rate)
"""
_ON_RATE = """FROM payment p LEFT JOIN validity v ON v.src = p.sourceCurrency AND v.dst = p.targetCurrency
  AND p.createdDate >= v.validFrom AND p.createdDate < v.validTo + INTERVAL 30 SECOND"""
_FROZEN = "coalesce(p.createdDate >= v.validTo, false) AS frozen"
_DAY = "time_bucket(INTERVAL 1 DAY, {ts}, TIMESTAMP '2000-01-01 08:30:00')"


def _day_totals(source: str, ts: str, by: str) -> str:
    day = _DAY.format(ts=ts)
    return f"""
SELECT {day} AS dayStart, {day} + INTERVAL 1 DAY AS dayEnd, {by}, count(amount) AS numTransfers, sum(amount) AS totalAmount
FROM {source} GROUP BY ALL"""


def oracle_sql() -> dict[str, str]:
    dfsp, hub = (QUOTED, DFSP_CORE), (QUOTED, HUB_CORE)
    hub_status = word("sb.word")
    return {
        "dfsp_daily_txn": statement(
            _report(
                "dfspCore", _DFSP_COLUMNS, "CASE WHEN p.receivedCurrency IS NULL THEN p.sentCurrency ELSE p.receivedCurrency END",
                "CASE WHEN sb.word IS NULL THEN sa.word ELSE sb.word END"), DETAILS, *dfsp),
        "hub_daily_txn": statement(_report("hubCore", _HUB_COLUMNS, "p.receivedCurrency", hub_status), DETAILS, *hub),
        "hub_daily_txn_anon": statement(
            _report("hubCore", _HUB_COLUMNS, "p.receivedCurrency", hub_status, identifiers=False), DETAILS, *hub),
        "hub_daily_txn_catalog": statement(_report("hubCore", _HUB_COLUMNS, "p.receivedCurrency", hub_status), DETAILS, *hub),
        "dfsp_daily_txn_ordered": statement(
            "SELECT *, row_number() OVER (ORDER BY createdDate, currentTransferID) AS ordinal FROM (" + _report(
                "dfspCore", _DFSP_COLUMNS, "CASE WHEN p.receivedCurrency IS NULL THEN p.sentCurrency ELSE p.receivedCurrency END",
                "CASE WHEN sb.word IS NULL THEN sa.word ELSE sb.word END") + ")", DETAILS, *dfsp),
        # The receiver is the second kind of party, which has two entries there.
        "dfsp_daily_txn_legacy_parties": statement(
            f"SELECT r.* FROM ({DFSP_LEGACY}) r JOIN (VALUES (1), (2)) AS entry(n) ON true", DETAILS, QUOTED),
        "settlement_window": statement(SETTLEMENT_WINDOW),
        "report_csv": statement(SETTLEMENT_WINDOW),
        "hub_report_csv": statement(_report("hubCore", _HUB_COLUMNS, "p.receivedCurrency", hub_status), DETAILS, *hub),
        "report_by_name": statement(_reconciliation(_OWN)),
        "txn_reconciliation": statement(_reconciliation(_OWN)),
        "txn_reconciliation_window": statement(_reconciliation(f"{_OWN} AND f.w = {RECONCILED_WINDOW_ID}")),
        "hub_daily_txn_legacy": statement(_reconciliation("true")),
        "reconciliation_amount": statement(RECONCILIATION_AMOUNT),
        "dfsp_daily_txn_legacy": statement(DFSP_LEGACY, DETAILS, QUOTED),
        "transfer_core_dfsp": statement("SELECT * FROM dfspCore", *dfsp),
        "transfer_core_hub": statement("SELECT * FROM hubCore", *hub),
        "latest_transfer_state": statement("SELECT transferId, state AS transferStateId, createdDate FROM latest"),
        "stream_transfer_states": statement("SELECT transferId, state AS transferStateId, createdDate FROM latest"),
        "leg_a_states": statement(
            """SELECT transferId, state AS transferStateId, createdDate, word AS enumeration FROM shown s
            WHERE EXISTS (SELECT 1 FROM dfspCore c WHERE c.legATransferId = s.transferId
              OR (c.legATransferId IS NULL AND c.currentHubTransferID = s.transferId))""", *dfsp),
        "leg_b_states": statement(
            """SELECT transferId, state AS transferStateId, createdDate, word AS enumeration FROM shown
            WHERE transferId IN (SELECT legBTransferId FROM dfspCore)""", *dfsp),
        "settlement_details": statement("SELECT * FROM details", DETAILS),
        "leg_a_settlement": statement(
            "SELECT * FROM details WHERE transferId IN (SELECT legATransferId FROM dfspCore)", DETAILS, *dfsp),
        "leg_b_settlement": statement(
            "SELECT * FROM details WHERE transferId IN (SELECT legBTransferId FROM dfspCore)", DETAILS, *dfsp),
        "counterparty_pairs": statement(
            """SELECT transferId, payerLineId, payerAccountId, payerAmount, payeeLineId, payeeAccountId FROM pair"""),
        "state_pair": statement(
            """SELECT CAST(f.w AS BIGINT) AS settlementWindowId, o.moment AS windowOpen, c.moment AS windowClose, count(*) AS numFulfilled
            FROM fulfilment f JOIN opened o ON o.w = f.w JOIN closed c ON c.w = f.w GROUP BY ALL"""),
        "fx_rate_decode": statement(
            f"""SELECT e.a AS transferAId, {word(float8('g.rate / pow(10, 3)'))} AS forexRate,
            {word(float8('p.sent * (g.rate / pow(10, 3)) - p.received'))} AS rounding
            FROM exchange e JOIN response p ON p.quoteId = e.qa LEFT JOIN rate g ON g.rateId = e.rateId"""),
        "quote_rule_events": statement(EVENTS, FACTS),
        "quote_invalid": statement("SELECT * FROM invalid", FACTS),
        "quote_intercept_by_account": statement("SELECT * FROM byAccount", FACTS),
        "quote_intercept_by_route": statement("SELECT * FROM byRoute", FACTS),
        "quote_account_currencies": statement(
            """SELECT quoteId, coalesce(payerHas, '') AS payerCurrencies,
            coalesce(payeeHas, '') AS payeeCurrencies, payerHas IS NOT NULL AS payerHasAccounts,
            payeeHas IS NOT NULL AS payeeHasAccounts FROM fact""", FACTS),
        "quote_fact_types": statement(
            """SELECT quoteId, payerHas IS NOT NULL AS payerAccountsIsArray, payeeHas IS NOT NULL AS payeeAccountsIsArray,
            hasInfo AS personalInfoIsObject, hasFirst AS firstNameIsString, hasLast AS lastNameIsString,
            born IS NOT NULL AS dateOfBirthIsString FROM fact""", FACTS),
        "fx_provider_lookup": statement("SELECT transferId, currencyId, 'DFSP' || currencyId AS dfsp FROM transfer"),
        "dfsp_registry": statement(
            """SELECT l.dfspId, l.currencyId, z.zoneName, l.isVirtual, coalesce(v.numSent, 0) AS numSent,
              coalesce(v.numReceived, 0) AS numReceived, v.totalAmount
            FROM (SELECT DISTINCT o.name AS dfspId, a.currencyId, o.participantId >= 100 AS isVirtual
              FROM participant o JOIN account a ON a.participantId = o.participantId) l
            JOIN (VALUES ('XOF','CFA Franc BCEAO'),('XTS','Testing currency'),('XXX','No currency'),('EUR','Euro'),
              ('MAD','Moroccan Dirham')) z(currencyId, zoneName) ON z.currencyId = l.currencyId
            LEFT JOIN (SELECT fspId, count(*) FILTER (WHERE kind = 'PAYER') AS numSent,
              count(*) FILTER (WHERE kind = 'PAYEE') AS numReceived, sum(amount) AS totalAmount
              FROM quoteParty GROUP BY fspId) v ON v.fspId = l.dfspId"""),
        "dfsp_id_valid": statement(
            """SELECT id AS fspId, length(id) BETWEEN 1 AND 32 AS isValidId,
              regexp_full_match(id, 'DFSP[A-Z]{3}') AS isVirtualName, count(*) AS numUses
            FROM (SELECT fspId AS id FROM quoteParty UNION ALL SELECT sourceFSP FROM exchange) GROUP BY ALL"""),
        "rate_validity_join": statement(
            f"""SELECT p.transferAId, p.sourceCurrency, p.targetCurrency, p.createdDate, v.rateId, v.rateValue, v.validFrom, {_FROZEN}
            {_ON_RATE}""", PAYMENTS),
        "rate_in_force": statement(
            f"""SELECT p.transferAId, p.sourceCurrency, p.targetCurrency, p.createdDate, v.rateId, v.rateValue, {_FROZEN}
            {_ON_RATE} QUALIFY row_number() OVER (PARTITION BY p.transferAId ORDER BY v.validFrom DESC) = 1""", PAYMENTS),
        "quote_expiry": statement(
            """SELECT t.transferId, q.quoteId, t.createdDate AS transferredAt, q.createdDate + INTERVAL 60 SECOND AS expiresAt,
            t.createdDate > q.createdDate + INTERVAL 60 SECOND AS expired
            FROM quote q JOIN transfer t ON t.transferId = q.transferId"""),
        "settlement_day": statement(_day_totals("transfer", "createdDate", "currencyId")),
        "net_position": statement(
            """SELECT o.participantId, o.name, o.currencyId, CAST(f.w AS BIGINT) AS settlementWindowId,
              sum(CASE WHEN l.role = 'PAYER_DFSP' THEN l.amount ELSE 0 END) AS debit,
              sum(CASE WHEN l.role = 'PAYER_DFSP' THEN 0 ELSE -l.amount END) AS credit, -sum(l.amount) AS netPosition
            FROM fulfilment f JOIN line l ON l.transferId = f.transferId JOIN owner o ON o.accountId = l.accountId
            WHERE f.w IS NOT NULL GROUP BY ALL"""),
        "transfer_timeout": statement(
            f"""SELECT p.transferId, p.createdDate AS preparedAt, c.createdDate AS fulfilledAt,
              p.createdDate + INTERVAL 432000 SECOND AS deadline
            FROM state p LEFT JOIN state c ON c.transferId = p.transferId AND c.state = 'COMMITTED'
            WHERE p.state = 'RECEIVED_PREPARE' AND p.createdDate + INTERVAL 432000 SECOND < TIMESTAMP '{TIMEOUT_AS_OF}'
            AND (c.createdDate IS NULL OR c.createdDate > p.createdDate + INTERVAL 432000 SECOND)"""),
        "stream_quote_events": statement(EVENTS, FACTS),
        "stream_latest_state": """SELECT user_id, event_type, ts FROM events
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
        "stream_settlement_day_totals": f"""
            WITH timed AS (SELECT ts, event_type, CAST(value AS DECIMAL(18,4)) AS amount FROM events)
            SELECT * FROM ({_day_totals('timed', 'ts', 'event_type')})
            WHERE dayEnd <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
        "stream_transfer_timeout": statement(
            """SELECT p.transferId, p.createdDate AS preparedAt FROM state p
            WHERE p.state = 'RECEIVED_PREPARE' AND p.createdDate + INTERVAL 432000 SECOND < (
              SELECT min(newest) - INTERVAL 1 HOUR FROM (SELECT max(createdDate) AS newest FROM state
                WHERE state IN ('RECEIVED_PREPARE', 'COMMITTED') GROUP BY state))
            AND NOT EXISTS (SELECT 1 FROM state c WHERE c.transferId = p.transferId AND c.state = 'COMMITTED'
              AND c.createdDate BETWEEN p.createdDate AND p.createdDate + INTERVAL 432000 SECOND)"""),
    }
