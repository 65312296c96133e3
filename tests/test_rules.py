"""The quote rules on hand-made facts."""

import json

import pytest

from clearbook.operators import rules
from clearbook.sources.schemas import QUOTE_FACT_COLUMNS

EVENT = {"type": "E", "params": {"p": "v"}}


def accounts(*currencies, active=1):
    return {"accounts": [{"ledgerAccountType": "POSITION", "isActive": active, "currency": c} for c in currencies]}


def quote(payer=None, payee=None, source="bank1", destination="bank2", kind="SEND", currency="EUR", body=None):
    info = {"complexName": {"firstName": "A", "lastName": "B"}, "dateOfBirth": "2000-01-01"}
    document = {
        "amountType": kind,
        "amount": {"amount": "1", "currency": currency},
        "payer": {"partyIdInfo": {"fspId": source}, "personalInfo": info},
        **(body or {}),
    }
    headers = {"fspiop-source": source, "fspiop-destination": destination}
    return headers, document, accounts("EUR") if payer is None else payer, accounts("EUR") if payee is None else payee


def facts(spark, *quotes):
    def text(document):
        return document if isinstance(document, str) else json.dumps(document)

    rows = [(f"q{n}", *map(text, q)) for n, q in enumerate(quotes)]
    return spark.createDataFrame(rows, QUOTE_FACT_COLUMNS)


def fired(spark, *quotes, wanted=None, using=None):
    events = rules.quote_events(facts(spark, *quotes), using, wanted).collect()
    return [sorted(e["ruleNo"] for e in events if e["quoteId"] == f"q{n}") for n in range(len(quotes))]


def holds(spark, conditions, *quotes):
    return [bool(f) for f in fired(spark, *quotes, using=[{"conditions": conditions, "event": EVENT}])]


def test_rule_list():
    standard = rules.standard_rules()
    types = [r["event"]["type"] for r in standard]
    assert (len(types), types.count(rules.INVALID), types.count(rules.INTERCEPT)) == (29, 10, 19)
    for r in standard:
        params = r["event"]["params"]
        assert params.get("rerouteToFsp", "DFSP" + params.get("sourceCurrency", "")) == "DFSP" + params.get("sourceCurrency", "")


def test_valid_quote_raises_nothing(spark):
    assert fired(spark, quote()) == [[]]


def test_accounts_must_be_a_list(spark):
    for payer in ({}, {"accounts": 5}, {"accounts": None}, "no json"):
        assert 0 in fired(spark, quote(payer=payer))[0]
    # Without accounts the currency is also unsupported.
    assert fired(spark, quote(payee={}))[0] == [1]
    assert fired(spark, quote(payee={}, kind="RECEIVE"))[0] == [1, 22]


def test_currency_of_amount(spark):
    unknown = fired(spark, quote(currency="ZZZ"), quote(currency="ZZZ", kind="RECEIVE"), quote(currency="ZZZ", kind="OTHER"))
    assert unknown == [[21], [22], []]


def test_inactive_and_other_accounts_do_not_count(spark):
    savings = {"accounts": [{"ledgerAccountType": "SETTLEMENT", "isActive": 1, "currency": "EUR"}]}
    assert fired(spark, quote(payer=accounts("EUR", active=0)), quote(payer=savings)) == [[21], [21]]
    assert fired(spark, quote(payer=accounts("EUR", active=True))) == [[]]


def test_sender_must_match_header(spark):
    info = {"complexName": {"firstName": "A", "lastName": "B"}, "dateOfBirth": "x"}
    stranger = {"payer": {"partyIdInfo": {"fspId": "other"}, "personalInfo": info}}
    foreign = accounts("MAD")
    assert 23 in fired(spark, quote(payee=foreign, body=stranger))[0]
    # Not when both sides know the currency, and not for the hub's own participants.
    assert fired(spark, quote(body=stranger)) == [[]]
    assert 23 not in fired(spark, quote(payee=foreign, source="DFSPEUR", body=stranger))[0]


@pytest.mark.parametrize(
    "info, expected",
    [
        (None, [24, 25, 26, 27]),
        ({"complexName": {"firstName": 7, "lastName": "B"}, "dateOfBirth": "x"}, [25]),
        ({"complexName": {"firstName": "A"}, "dateOfBirth": "x"}, [26]),
        ({"complexName": {"firstName": "A", "lastName": "B"}}, [27]),
        ({"complexName": {"firstName": "A", "lastName": "B"}, "dateOfBirth": ""}, [28]),
        ({"complexName": {"firstName": "", "lastName": ""}, "dateOfBirth": "x"}, []),
    ],
)
def test_personal_information(spark, info, expected):
    payer = {"partyIdInfo": {"fspId": "bank1"}} | ({} if info is None else {"personalInfo": info})
    assert fired(spark, with_payer(payer), wanted=rules.INVALID) == [expected]


def with_payer(payer):
    headers, body, payer_accounts, _ = quote()
    return headers, body | {"payer": payer}, payer_accounts, accounts("UGX")


def test_reroute_by_account_needs_exactly_one_currency(spark):
    pair = quote(payer=accounts("MAD"), payee=accounts("EUR"), currency="MAD")
    two = quote(payer=accounts("MAD", "XOF"), payee=accounts("EUR"), currency="MAD")
    hub = quote(payer=accounts("MAD"), payee=accounts("EUR"), currency="MAD", source="DFSPMAD")
    barred = quote(payer=accounts("XOF"), payee=accounts("MAD"), currency="XOF", source="testfsp5")
    assert fired(spark, pair, two, hub, barred, wanted=rules.INTERCEPT) == [[2], [], [], []]


def test_reroute_tables_agree_with_the_rules(spark, ledger):
    quotes = ledger["quoteFacts"]
    columns = ["quoteId", "ruleNo", *rules.REROUTE_PARAMS]
    by_rules = rules.event_rows(rules.quote_events(quotes, wanted=rules.INTERCEPT)).select(*columns)
    by_table = rules.intercepts_by_account(quotes).unionByName(rules.intercepts_by_route(quotes))
    assert by_rules.exceptAll(by_table).count() == 0
    assert by_table.exceptAll(by_rules).count() == 0
    assert by_rules.count() > 0


def test_reroute_table_reads_each_account_list_once(spark, ledger):
    plan = rules.intercepts_by_account(ledger["quoteFacts"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count('["accounts"]') == 2


def test_reroute_table_with_odd_account_lists(spark):
    def side(*currencies):
        accounts = [{"ledgerAccountType": "POSITION", "isActive": 1, "currency": c} for c in currencies]
        return json.dumps({"accounts": accounts})

    headers, mad, eur = json.dumps({"fspiop-source": "bank"}), side("MAD"), side("EUR")
    sides = [(mad, eur), (side("MAD", "XOF"), eur), (side(), eur), (side(None), eur), (None, eur), ("{}", eur), ("no JSON", eur), (side("MAD", None), eur), (mad, None)]
    facts = spark.createDataFrame([(str(n), headers, "{}", *s) for n, s in enumerate(sides)], QUOTE_FACT_COLUMNS)
    assert [r["quoteId"] for r in rules.intercepts_by_account(facts).collect()] == ["0"]


def test_every_rule_fires_on_the_derived_facts(ledger, spark):
    events = rules.quote_events(ledger["quoteFacts"]).select("ruleNo").distinct().count()
    assert events >= 25  # All 29 at a tenth of the smallest benchmark size.


def test_result_does_not_depend_on_partitioning(ledger):
    quotes = ledger["quoteFacts"]
    one = rules.event_rows(rules.quote_events(quotes.repartition(1)))
    many = rules.event_rows(rules.quote_events(quotes.repartition(13)))
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0


def test_comparison_is_strict_about_types(spark):
    name = ("payload", "$.amountType")
    number = quote(kind=5)
    assert holds(spark, {"all": [rules.condition(name, "equal", "5")]}, number, quote(kind="5")) == [False, True]
    assert holds(spark, {"all": [rules.condition(name, "equal", 5)]}, number, quote(kind="5")) == [True, False]
    assert holds(spark, {"all": [rules.condition(name, "equal", True)]}, quote(kind=True), quote(kind="true")) == [True, False]


def test_missing_facts(spark):
    absent = ("payload", "$.nothing.here")
    single = [
        ("equal", "x", False),
        ("notEqual", "x", True),
        ("in", ["x"], False),
        ("notIn", ["x"], True),
        ("isString", True, False),
        ("isString", False, True),
    ]
    for operator, value, expected in single:
        assert holds(spark, {"all": [rules.condition(absent, operator, value)]}, quote()) == [expected]


def test_any_and_nested(spark):
    eur = rules.condition(rules.AMOUNT_CURRENCY, "equal", "EUR")
    mad = rules.condition(rules.AMOUNT_CURRENCY, "equal", "MAD")
    send = rules.condition(rules.AMOUNT_TYPE, "equal", "SEND")
    tree = {"all": [{"any": [eur, mad]}, send]}
    quotes = [quote(), quote(currency="MAD"), quote(currency="XOF"), quote(kind="RECEIVE")]
    assert holds(spark, tree, *quotes) == [True, True, False, False]


def test_rules_from_a_file(spark, tmp_path):
    path = tmp_path / "rules.json"
    path.write_text(json.dumps(rules.standard_rules(), indent=1))
    assert rules.load_rules(spark, str(path)) == rules.standard_rules()


def test_unknown_operator_is_an_error(spark):
    with pytest.raises(ValueError, match="unknown operator"):
        holds(spark, {"all": [rules.condition(rules.SOURCE, "resembles", "x")]}, quote())
