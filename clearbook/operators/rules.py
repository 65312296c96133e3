"""Quote rules evaluated as Column expressions over a DataFrame of quote facts.

A rule is a condition tree and an event. Its conditions read the facts
``headers``, ``payload``, ``payer`` and ``payee`` (JSON text) by path. Every rule that
holds emits its event, in the order of the rule list. Nothing is shuffled and
no Python runs per row: each document is parsed once to a VARIANT, each path is
read once, and each rule becomes a boolean expression over these values.
"""

from __future__ import annotations

import json
import re
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FACTS = ("headers", "payload", "payer", "payee")
INVALID, INTERCEPT = "INVALID_QUOTE_REQUEST", "INTERCEPT_QUOTE"

# Participants that are part of the hub, error names and messages,
# the paths that are read, and the currency and route pairs that are rerouted.
HUB_FSPS = ["DFSPEUR", "DFSPMAD", "DFSPUGX", "DFSPZMW", "DFSPRWF", "DFSPGHS", "DFSPXOF", "DFSPXTS", "DFSPXXX"]
SOURCE, DESTINATION = ("headers", "$.fspiop-source"), ("headers", "$.fspiop-destination")
AMOUNT_TYPE, AMOUNT_CURRENCY = ("payload", "$.amountType"), ("payload", "$.amount.currency")
POSITION_CURRENCIES = "$.accounts[?(@.ledgerAccountType == 'POSITION' && @.isActive == 1)].currency"
BIRTH_DATE = ("payload", "$.payer.personalInfo.dateOfBirth")

Fact = tuple[str, str]


# Conditions in the JSON form of the rule list.


def condition(fact: Fact, operator: str, value: Any) -> dict:
    return {"fact": fact[0], "path": fact[1], "operator": operator, "value": value}


def fact_value(fact: Fact) -> dict:
    return {"fact": fact[0], "path": fact[1]}


def position_currencies(side: str) -> Fact:
    return side, POSITION_CURRENCIES


def rule(conditions: list[dict], event: str, **params: str) -> dict:
    return {"conditions": {"all": conditions}, "event": {"type": event, "params": params}}


def invalid(error: str, message: str, *conditions: dict) -> dict:
    return rule(list(conditions), INVALID, FSPIOPError=error, message=message)


def intercept(source: str, target: str, conditions: list[dict]) -> dict:
    params = {"rerouteToFsp": f"DFSP{source}", "sourceCurrency": source, "rerouteToFspCurrency": target}
    return rule(conditions, INTERCEPT, **params)


def account_route(source: str, target: str, also_internal: tuple[str, ...] = ()) -> dict:
    """Reroute quotes between accounts of two currencies, unless they come from the hub itself."""
    return intercept(
        source,
        target,
        [
            condition(SOURCE, "notIn", HUB_FSPS + list(also_internal)),
            condition(position_currencies("payer"), "equal", source),
            condition(position_currencies("payee"), "equal", target),
        ],
    )


def party_route(payer: str, payee: str, amount_type: str, source: str, target: str) -> dict:
    """Reroute quotes between two participants in one of the currencies of the pair."""
    return intercept(
        source,
        target,
        [
            condition(SOURCE, "notIn", HUB_FSPS),
            condition(SOURCE, "equal", payer),
            condition(DESTINATION, "equal", payee),
            condition(AMOUNT_TYPE, "equal", amount_type),
            condition(AMOUNT_CURRENCY, "equal", source if amount_type == "SEND" else target),
        ],
    )


def currency_unknown_to(side: str) -> dict:
    return condition(AMOUNT_CURRENCY, "notIn", fact_value(position_currencies(side)))


def standard_rules() -> list[dict]:
    """The rule list, in the order its events are emitted."""
    foreign = {"any": [currency_unknown_to("payee"), currency_unknown_to("payer")]}

    def needed(name: str, path: str, kind: str) -> dict:
        fact = ("payload", f"$.payer.personalInfo{path}")
        return invalid("MISSING_ELEMENT", f"{name} is required", foreign, condition(fact, kind, False))

    def unsupported(amount_type: str, side: str) -> dict:
        return invalid(
            f"{side.upper()}_UNSUPPORTED_CURRENCY",
            f"Requested currency not available for {side}",
            condition(AMOUNT_TYPE, "equal", amount_type),
            currency_unknown_to(side),
        )

    # Texts and order of the rules.
    return [
        invalid("PAYER_ERROR", "Payer does not have any active account",
                condition(("payer", "$.accounts"), "isArray", False)),
        invalid("PAYEE_ERROR", "Payee does not have any active accounts",
                condition(("payee", "$.accounts"), "isArray", False)),
        account_route("MAD", "EUR"),
        account_route("XOF", "MAD", also_internal=("testfsp5",)),
        party_route("testfsp5", "testfsp4", "SEND", "XOF", "MAD"),
        party_route("testfsp5", "testfsp4", "RECEIVE", "XOF", "MAD"),
        account_route("MAD", "XOF"),
        account_route("XOF", "EUR"),
        account_route("EUR", "XOF"),
        account_route("EUR", "MAD"),
        account_route("EUR", "GHS"),
        party_route("testfsp5", "testfsp6", "SEND", "UGX", "ZMW"),
        party_route("testfsp5", "testfsp6", "RECEIVE", "UGX", "ZMW"),
        party_route("testfsp6", "testfsp5", "SEND", "ZMW", "UGX"),
        party_route("testfsp6", "testfsp5", "RECEIVE", "ZMW", "UGX"),
        account_route("UGX", "RWF"),
        account_route("RWF", "UGX"),
        account_route("ZMW", "RWF"),
        account_route("RWF", "ZMW"),
        account_route("XTS", "XXX"),
        account_route("XXX", "XTS"),
        unsupported("SEND", "payer"),
        unsupported("RECEIVE", "payee"),
        invalid("VALIDATION_ERROR", "The payer FSP does not match the fspiop-source header",
                foreign,
                condition(SOURCE, "notIn", HUB_FSPS),
                condition(SOURCE, "notEqual", fact_value(("payload", "$.payer.partyIdInfo.fspId")))),
        needed("PartyPersonalInfo", "", "isObject"),
        needed("firstName", ".complexName.firstName", "isString"),
        needed("lastName", ".complexName.lastName", "isString"),
        needed("dateOfBirth", ".dateOfBirth", "isString"),
        invalid("MALFORMED_SYNTAX", "Malformed Payer dateOfBirth", foreign, condition(BIRTH_DATE, "equal", "")),
    ]


def load_rules(spark: SparkSession, path: str) -> list[dict]:
    """A rule list from a JSON file, a few dozen rules at most."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


# From a rule list to expressions.

_FILTERED = re.compile(r"^\$\.(?P<array>[\w.-]+)\[\?\((?P<tests>.+)\)\]\.(?P<field>[\w-]+)$")
_TEST = re.compile(r"^\s*@\.(?P<field>[\w-]+)\s*==\s*(?P<value>'[^']*'|[\d.]+)\s*$")
TYPE_CHECKS = ("isArray", "isObject", "isString")
_CONTAINERS = {"isArray": "array<variant>", "isObject": "map<string,variant>"}


def _variant_path(path: str) -> str:
    """``$.a.b-c`` with every name quoted, as hyphens need it."""
    names = [n for n in path.removeprefix("$").split(".") if n]
    return "$" + "".join(f'["{n}"]' for n in names)


def is_list_path(path: str) -> bool:
    return _FILTERED.match(path) is not None


def _items(fact: Column, path: str) -> tuple[Column, str]:
    """The elements that pass the filter of a path, and the path of the field it selects."""
    filtered = _FILTERED.match(path)
    tests = []
    for text in filtered["tests"].split("&&"):
        test = _TEST.match(text)
        if not test:
            raise ValueError(f"cannot read the filter of {path!r}")
        tests.append((_variant_path(f"$.{test['field']}"), test["value"]))

    def passes(item: Column) -> Column:
        # A flag may be 1 or true: both read as 1.0.
        checks = [
            F.try_variant_get(item, p, "string") == v[1:-1]
            if v.startswith("'")
            else F.try_variant_get(item, p, "double") == float(v)
            for p, v in tests
        ]
        return reduce(and_, checks)

    items = F.try_variant_get(fact, _variant_path(f"$.{filtered['array']}"), "array<variant>")
    return F.filter(items, passes), _variant_path(f"$.{filtered['field']}")


def listed_strings(fact: Column, path: str) -> Column:
    """The strings a filtered array path selects, NULL without the array."""
    items, field = _items(fact, path)
    return F.transform(items, lambda item: F.try_variant_get(item, field, "string"))


def json_value(fact: Column, path: str) -> Column:
    """The value at a path as JSON text, which keeps its type: ``"5"`` differs from ``5``.

    A filtered array path gives an array of such texts.
    """
    if is_list_path(path):
        items, field = _items(fact, path)
        return F.transform(items, lambda item: F.to_json(F.try_variant_get(item, field, "variant")))
    return F.to_json(F.try_variant_get(fact, _variant_path(path), "variant"))


def has_type(fact: Column, path: str, check: str) -> Column:
    """Whether the value at a path is an array, an object or a string; absent values are none."""
    if check == "isString":
        return _never_null(json_value(fact, path).startswith('"'))
    return F.try_variant_get(fact, _variant_path(path), _CONTAINERS[check]).isNotNull()


def _reads(node: Any) -> set[tuple[str, str, str]]:
    """Every (fact, path, use) of a condition tree; the use is a type check or ``value``."""
    if isinstance(node, list):
        return set().union(*map(_reads, node)) if node else set()
    if not isinstance(node, dict):
        return set()
    operator = node.get("operator")
    use = operator if operator in TYPE_CHECKS else "value"
    own = {(node["fact"], node["path"], use)} if "fact" in node else set()
    return own.union(*map(_reads, node.values()))


class _Values:
    """Columns that hold what the conditions read, each computed once per quote."""

    def __init__(self, rules: list[dict]):
        self.names = {read: f"_v{n}" for n, read in enumerate(sorted(_reads([r["conditions"] for r in rules])))}

    def columns(self) -> list[Column]:
        return [
            (json_value(F.col(f"_{fact}"), path) if use == "value" else has_type(F.col(f"_{fact}"), path, use)).alias(name)
            for (fact, path, use), name in self.names.items()
        ]

    def column(self, fact: str, path: str, use: str = "value") -> Column:
        return F.col(self.names[fact, path, use])


def _never_null(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def _equals(value: Column, path: str, expected: Any) -> Column:
    if is_list_path(path):
        # A list equals a value if that is its only element.
        return (F.size(value) == 1) & _equals(F.get(value, F.lit(0)), "", expected)
    if isinstance(expected, (int, float)) and not isinstance(expected, bool):
        return value.try_cast("double") == float(expected)
    return value == json.dumps(expected, ensure_ascii=False)


def _holds(values: _Values, node: dict) -> Column:
    if "all" in node:
        return reduce(and_, [_holds(values, n) for n in node["all"]])
    if "any" in node:
        return reduce(or_, [_holds(values, n) for n in node["any"]])
    fact, path, operator, expected = node["fact"], node["path"], node["operator"], node["value"]
    if operator in TYPE_CHECKS:
        return values.column(fact, path, operator) == F.lit(expected)
    value = values.column(fact, path)
    other = values.column(expected["fact"], expected["path"]) if isinstance(expected, dict) else None
    if operator in ("equal", "notEqual"):
        same = _never_null(_equals(value, path, expected)) if other is None else value.eqNullSafe(other)
        return same if operator == "equal" else ~same
    if operator in ("in", "notIn"):
        if other is None:
            found = reduce(or_, [_equals(value, path, e) for e in expected], F.lit(False))
        else:
            found = F.array_contains(other, value)
        return _never_null(found) if operator == "in" else ~_never_null(found)
    raise ValueError(f"unknown operator {operator!r}")


def quote_events(facts: DataFrame, rules: list[dict] | None = None, wanted: str | None = None) -> DataFrame:
    """The events of every quote: ``quoteId, ruleNo, eventType, params``.

    ``ruleNo`` is the rule's place in the list; ``wanted`` keeps one event type.
    """
    rules = standard_rules() if rules is None else rules
    numbered = [(n, r) for n, r in enumerate(rules) if wanted in (None, r["event"]["type"])]
    values = _Values([r for _, r in numbered])
    parsed = facts.select("quoteId", *[F.try_parse_json(f).alias(f"_{f}") for f in FACTS])
    read = parsed.select("quoteId", *values.columns())

    def event(number: int, r: dict) -> Column:
        params = [F.lit(x) for item in r["event"]["params"].items() for x in item]
        return F.when(
            _holds(values, r["conditions"]),
            F.struct(
                F.lit(number).alias("ruleNo"),
                F.lit(r["event"]["type"]).alias("eventType"),
                F.create_map(*params).alias("params"),
            ),
        )

    events = F.array_compact(F.array(*[event(n, r) for n, r in numbered]))
    # Exploded in place: given a name first, Spark would evaluate the values once per rule.
    return read.select("quoteId", F.inline(events))


def _params(*names: str) -> list[Column]:
    return [F.col("params")[n].alias(n) for n in names]


ERROR_PARAMS = ("FSPIOPError", "message")
REROUTE_PARAMS = ("rerouteToFsp", "sourceCurrency", "rerouteToFspCurrency")


def event_rows(events: DataFrame) -> DataFrame:
    """Events with one column per standard parameter."""
    return events.select("quoteId", "ruleNo", "eventType", *_params(*ERROR_PARAMS, *REROUTE_PARAMS))


def invalid_quotes(facts: DataFrame) -> DataFrame:
    """Quotes to reject, one row per error."""
    return quote_events(facts, wanted=INVALID).select("quoteId", "ruleNo", *_params(*ERROR_PARAMS))


def position_currency_lists(facts: DataFrame) -> DataFrame:
    """Currencies of the active position accounts of both sides, NULL without accounts."""
    return facts.select(
        "quoteId",
        *[
            listed_strings(F.try_parse_json(side), POSITION_CURRENCIES).alias(f"{side}Currencies")
            for side in ("payer", "payee")
        ],
    )


def _reroutes(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """A constant route table; its size is fixed, so it is broadcast."""
    quoted = ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)
    return F.broadcast(spark.sql(f"SELECT * FROM VALUES {quoted} AS t({', '.join(columns)})"))


def _route_of(r: dict) -> dict[Fact, str]:
    """What a reroute rule compares for equality, by fact."""
    tests = r["conditions"]["all"]
    return {(c["fact"], c["path"]): c["value"] for c in tests if c.get("operator") == "equal"}


def intercepts_by_account(facts: DataFrame) -> DataFrame:
    """Reroutes by the currencies of both sides' accounts, as a look-up in a table of pairs."""
    payer, payee = position_currencies("payer"), position_currencies("payee")
    rows = []
    for number, r in enumerate(standard_rules()):
        route = _route_of(r)
        if r["event"]["type"] == INTERCEPT and payer in route:
            barred = next(c["value"] for c in r["conditions"]["all"] if c["operator"] == "notIn")
            rows.append((number, route[payer], route[payee], "|".join(barred), r["event"]["params"]["rerouteToFsp"]))
    routes = _reroutes(
        facts.sparkSession, ["ruleNo", "sourceCurrency", "rerouteToFspCurrency", "barred", "rerouteToFsp"], rows
    )

    def only(currencies: Column) -> Column:
        # As a filter over the one list, so that the list is read once.
        return F.get(F.flatten(F.filter(F.array(currencies), lambda c: F.size(c) == 1)), F.lit(0))

    read = F.struct(
        F.try_variant_get(F.try_parse_json("headers"), _variant_path(SOURCE[1]), "string").alias("source"),
        only(listed_strings(F.try_parse_json("payer"), POSITION_CURRENCIES)).alias("sourceCurrency"),
        only(listed_strings(F.try_parse_json("payee"), POSITION_CURRENCIES)).alias("rerouteToFspCurrency"),
    )
    # Exploded in place: the join's tests for NULL would else read the documents a second time.
    quotes = facts.select("quoteId", F.inline(F.array(read)))
    allowed = ~_never_null(F.array_contains(F.split("barred", "[|]"), F.col("source")))
    return (
        quotes.join(routes, ["sourceCurrency", "rerouteToFspCurrency"])
        .where(allowed)
        .select("quoteId", "ruleNo", *REROUTE_PARAMS)
    )


def intercepts_by_route(facts: DataFrame) -> DataFrame:
    """Reroutes by source, destination, amount type and currency, as a look-up in a table of routes.

    No route starts at the hub, so the source needs no further check.
    """
    compared = [SOURCE, DESTINATION, AMOUNT_TYPE, AMOUNT_CURRENCY]
    keys = ["source", "destination", "amountType", "amountCurrency"]
    rows = []
    for number, r in enumerate(standard_rules()):
        route = _route_of(r)
        if r["event"]["type"] == INTERCEPT and SOURCE in route:
            rows.append((number, *[route[c] for c in compared], *r["event"]["params"].values()))
    routes = _reroutes(facts.sparkSession, ["ruleNo", *keys, *REROUTE_PARAMS], rows)
    quotes = facts.select(
        "quoteId",
        *[
            F.try_variant_get(F.try_parse_json(fact), _variant_path(path), "string").alias(key)
            for (fact, path), key in zip(compared, keys)
        ],
    )
    return quotes.join(routes, keys).select("quoteId", "ruleNo", *REROUTE_PARAMS)


def fact_types(facts: DataFrame) -> DataFrame:
    """Whether the parts of a quote that the rules check have the type they need."""
    info = "$.payer.personalInfo"

    def has(fact: str, path: str, check: str) -> Column:
        return has_type(F.try_parse_json(fact), path, check)

    return facts.select(
        "quoteId",
        has("payer", "$.accounts", "isArray").alias("payerAccountsIsArray"),
        has("payee", "$.accounts", "isArray").alias("payeeAccountsIsArray"),
        has("payload", info, "isObject").alias("personalInfoIsObject"),
        has("payload", f"{info}.complexName.firstName", "isString").alias("firstNameIsString"),
        has("payload", f"{info}.complexName.lastName", "isString").alias("lastNameIsString"),
        has("payload", f"{info}.dateOfBirth", "isString").alias("dateOfBirthIsString"),
    )
