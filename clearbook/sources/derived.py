"""A ledger derived from the star-schema tables (orders, lineitem, customer, ...).

Nations act as participants, regions as currency zones, and each zone has one
virtual participant that provides foreign exchange. An order whose customer and
supplier share a region is a domestic transfer ``D<k>``; any other order is an
exchange payment with leg ``A<k>`` and, unless its priority is ``5-LOW``, a
second leg ``B<k>``.

The order-sized tables are written once per application to the shared folder,
in folders by the period of the payment and bucketed on the id they are joined on,
so the reports read only the periods of their quotes and merge tables without shuffling them. The window and settlement tables have a few rows per month.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import timedelta
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbook.operators.joins import lookup
from clearbook.session import file_system, run_folder
from clearbook.sources.periods import period_of, without_layout
from clearbook.sources.quote_facts import quote_facts
from clearbook.sources.reference_data import ZONE_NAMES
from clearbook.sources.schemas import LEDGER_COLUMNS

# Currency of each region, in region order.
ZONE_CURRENCIES = ["XOF", "XTS", "XXX", "EUR", "MAD"]

# Last settlement window that is still open, as year * 12 + month.
OPEN_WINDOW = 2001 * 12 + 6

# Input bytes for each bucket: what a task sorts or merges then stays a few hundred megabytes at any size of input.
BYTES_PER_BUCKET = 16 << 20
FEWEST_BUCKETS, MOST_BUCKETS = 8, 4096


def _currency(zone: str) -> Column:
    return F.get(F.array(*[F.lit(c) for c in ZONE_CURRENCIES]), F.col(zone))


def _seconds(count: int) -> Column:
    return F.lit(timedelta(seconds=count))


def quoted_at(ts: str) -> Column:
    """When the quote of a transfer was made."""
    return F.col(ts) - _seconds(5)


def payment_legs(spark: SparkSession, sf_dir: str, unit: str = "year") -> DataFrame:
    """One row per transfer: domestic, exchange leg A or exchange leg B.

    ``period`` is the first day of the year, month or day in which the payment's quotes are made.
    """

    def read(table: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{table}.parquet")

    # Pre-aggregated per task, so one order may hold any share of the lines.
    paid = read("lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(
        F.min("l_suppkey").alias("s_suppkey"),
        F.max("l_extendedprice").cast("decimal(18,4)").alias("amt"),
    )
    nation = read("nation")

    def located(key: str, zone: str, name: str) -> DataFrame:
        return lookup(
            nation.select(
                F.col("n_nationkey").alias(key), F.col("n_regionkey").alias(zone), F.col("n_name").alias(name)
            )
        )

    customer = read("customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_name").alias("payerParty"), F.col("c_nationkey").alias("pn")
    )
    supplier = read("supplier").select(
        "s_suppkey", F.col("s_name").alias("payeeParty"), F.col("s_nationkey").alias("en")
    )
    key_seconds = (F.col("k") % 86400 + (F.col("k") % 1000) / F.lit(1000)).cast("decimal(18,6)")
    payments = (
        read("orders")
        .select(
            F.col("o_orderkey").alias("k"),
            "o_custkey",
            "o_orderdate",
            F.col("o_orderstatus").alias("st"),
            F.col("o_orderpriority").alias("pri"),
        )
        .join(paid, "k")
        .join(customer, "o_custkey")
        .join(supplier, "s_suppkey")
        .join(located("pn", "pr", "pname"), "pn")
        .join(located("en", "er", "ename"), "en")
        .withColumn("ts", F.col("o_orderdate") + F.make_dt_interval(secs=key_seconds))
    )

    def leg(number: int, letter: str, payer: Column, payee: Column, zone: str) -> Column:
        return F.struct(
            F.lit(number).alias("leg"),
            F.concat(F.lit(letter), F.col("k")).alias("transferId"),
            F.concat(F.lit("Q" + letter), F.col("k")).alias("quoteId"),
            payer.alias("payerPid"),
            payee.alias("payeePid"),
            F.col(zone).alias("cur"),
        )

    payer_bank, payee_bank = F.col("pn") + 1, F.col("en") + 1
    first = leg(1, "A", payer_bank, F.col("pr") + 100, "pr")
    second = leg(2, "B", F.col("er") + 100, payee_bank, "er")
    legs = (
        F.when(F.col("pr") == F.col("er"), F.array(leg(0, "D", payer_bank, payee_bank, "pr")))
        .when(F.col("pri") != "5-LOW", F.array(first, second))
        .otherwise(F.array(first))
    )
    payments = payments.withColumn("period", period_of(quoted_at("ts"), unit))
    kept = ["period", "k", "ts", "st", "pri", "pn", "en", "pname", "ename", "pr", "er", "payerParty", "payeeParty", "amt"]
    return payments.select(*kept, F.inline(legs))


def _transfer(legs: DataFrame) -> DataFrame:
    return legs.select(
        "period",
        "transferId",
        F.col("amt").alias("amount"),
        _currency("cur").alias("currencyId"),
        F.col("ts").alias("createdDate"),
    )


def _transfer_participant(legs: DataFrame) -> DataFrame:
    def line(role: int, pid: str, amount: Column) -> Column:
        return F.struct(
            (F.col("k") * 8 + F.col("leg") * 2 + (role - 1)).alias("transferParticipantId"),
            "transferId",
            (F.col(pid) + 1000).alias("participantCurrencyId"),
            F.lit(role).alias("transferParticipantRoleTypeId"),
            amount.cast("decimal(18,4)").alias("amount"),
        )

    return legs.select("period", F.inline(F.array(line(1, "payerPid", F.col("amt")), line(2, "payeePid", -F.col("amt")))))


def _quote(legs: DataFrame) -> DataFrame:
    return legs.select(
        "period",
        "quoteId",
        F.when(F.col("pri") == "1-URGENT", F.concat(F.lit("TR"), "k")).alias("transactionRequestId"),
        F.when(F.col("k") % 5 == 0, 2).otherwise(1).alias("transactionScenarioId"),
        quoted_at("ts").alias("createdDate"),
        F.col("period").alias("quotedIn"),
    )


def _transaction_reference(legs: DataFrame) -> DataFrame:
    return legs.select("period", "quoteId", F.col("transferId").alias("transactionReferenceId"))


def _quote_party(legs: DataFrame) -> DataFrame:
    def party(role: int, nation: str, fsp: str, person: str, amount: Column) -> Column:
        return F.struct(
            "quoteId",
            F.lit(role).alias("partyTypeId"),
            F.lit(role).alias("transferParticipantRoleTypeId"),
            (F.col(nation) + 1).alias("participantId"),
            F.col(fsp).alias("fspId"),
            F.col(person).alias("partyIdentifierValue"),
            _currency("cur").alias("currencyId"),
            amount.cast("decimal(18,4)").alias("amount"),
        )

    payer = party(1, "pn", "pname", "payerParty", F.col("amt"))
    payee = party(2, "en", "ename", "payeeParty", -F.col("amt"))
    return legs.select("period", F.inline(F.array(payer, payee)))


def _quote_response(legs: DataFrame) -> DataFrame:
    converted = F.col("leg") == 1
    return legs.select(
        "period",
        "quoteId",
        _currency("cur").alias("transferAmountCurrencyId"),
        F.col("amt").alias("transferAmount"),
        F.when(converted, _currency("er")).alias("payeeReceiveAmountCurrencyId"),
        F.when(converted, (F.col("amt") * 2).cast("decimal(18,4)")).alias("payeeReceiveAmount"),
    )


def _fx_transaction(legs: DataFrame) -> DataFrame:
    def tagged(prefix: str) -> Column:
        return F.concat(F.lit(prefix), F.col("k"))

    return legs.where(F.col("leg") == 2).select(
        "period",
        tagged("A").alias("transferAId"),
        F.col("transferId").alias("transferBId"),
        tagged("QA").alias("fxQuoteAId"),
        tagged("FX").alias("fxQuoteBId"),
        (F.col("pr") * 5 + F.col("er")).alias("exchangeRateId"),
    )


def _fx_quote(legs: DataFrame) -> DataFrame:
    return legs.where(F.col("leg") == 2).select(
        "period",
        F.concat(F.lit("FX"), "k").alias("fxQuoteId"), F.concat(F.lit("DFSP"), _currency("er")).alias("sourceFSP")
    )


def _transfer_state_change(legs: DataFrame) -> DataFrame:
    def change(step: int, state: str) -> Column:
        return F.struct(
            ((F.col("k") * 10 + step) * 3 + F.col("leg")).alias("transferStateChangeId"),
            "transferId",
            F.lit(state).alias("transferStateId"),
            (F.col("ts") + _seconds(step - 1)).alias("createdDate"),
        )

    history = F.array_compact(
        F.array(
            change(1, "RECEIVED_PREPARE"),
            F.when(F.col("st") != "O", change(2, "RESERVED")),
            F.when(F.col("st") == "F", change(3, "COMMITTED")),
            F.when(_aborted(), change(3, "ABORTED_ERROR")),
        )
    )
    return legs.select("period", F.inline(history))


def _aborted() -> Column:
    return (F.col("st") == "O") & (F.col("k") % 7 == 0)


def _transfer_error(legs: DataFrame) -> DataFrame:
    return legs.where(_aborted()).select("period", "transferId", F.lit("4001").alias("errorCode"))


def _month_number(ts: str) -> Column:
    return (F.year(ts) * 12 + F.month(ts)).cast("bigint")


def _transfer_fulfilment(legs: DataFrame) -> DataFrame:
    window = F.when(F.col("k") % 11 != 0, _month_number("ts"))
    return legs.where(F.col("st") == "F").select(
        "period", "transferId", window.alias("settlementWindowId"), window.alias("inWindow")
    )


# Order-sized tables and the column each is bucketed on.
STORED: dict[str, tuple[Callable[[DataFrame], DataFrame], str]] = {
    "transfer": (_transfer, "transferId"),
    "transferParticipant": (_transfer_participant, "transferId"),
    "quote": (_quote, "quoteId"),
    "transactionReference": (_transaction_reference, "quoteId"),
    "quoteParty": (_quote_party, "quoteId"),
    "quoteResponse": (_quote_response, "quoteId"),
    "fxTransaction": (_fx_transaction, "transferAId"),
    "fxQuote": (_fx_quote, "fxQuoteId"),
    "transferStateChange": (_transfer_state_change, "transferId"),
    "transferError": (_transfer_error, "transferId"),
    "transferFulfilment": (_transfer_fulfilment, "transferId"),
}
# Order-sized tables that are only scanned, and the column of the legs that deals their rows: they need no order.
# Their files are small in bytes but take long to evaluate, so there are several for each bucket of the others.
SCANNED: dict[str, tuple[Callable[[DataFrame], DataFrame], str]] = {"quoteFacts": (quote_facts, "quoteId")}
SCANNED_FILES_PER_BUCKET = 4

# What lies in folders of its own: rows by the period of their payment, quotes by that in which
# they were made, fulfilments also by their settlement window. Quotes are sorted by time in a file.
PARTITIONED = {"quote": ["quotedIn"], "transferFulfilment": ["period", "inWindow"]}
SORTED = {"quote": "createdDate"}
# Input bytes up to which a period is a year, and a month; beyond, it is a day.
BYTES_BY_YEAR, BYTES_BY_MONTH = 64 << 30, 1 << 40

# Tables of other services, and what their namespace's name ends with.
ELSEWHERE = {"fxTransaction": "adapter", "fxQuote": "adapter", "exchange_channel_rates": "rates", "citiExchangeRate": "rates"}

# The lookup tables that hold no more than these rows.
LOOKUPS: dict[str, list[tuple]] = {
    "transferParticipantRoleType": [(1, "PAYER_DFSP"), (2, "PAYEE_DFSP"), (3, "HUB")],
    "partyType": [(1, "PAYER"), (2, "PAYEE")],
    "party": [(1, "Ada", "Payer"), (2, "Ben", "Payee")],
    "transactionScenario": [(1, "TRANSFER"), (2, "PAYMENT")],
    "transferState": [
        ("RECEIVED_PREPARE", "RECEIVED"),
        ("RESERVED", "RESERVED"),
        ("COMMITTED", "COMMITTED"),
        ("ABORTED_ERROR", "ABORTED"),
    ],
}


def _zone_pairs() -> list[tuple[int, int]]:
    zones = range(len(ZONE_CURRENCIES))
    return [(s, d) for s in zones for d in zones if s != d]


def literal_table(spark: SparkSession, columns: str, rows: list[tuple]) -> DataFrame:
    """A handful of constant rows that Spark plans as a local relation."""
    names = [c.split()[0] for c in columns.split(", ")]
    types = [c.split()[1] for c in columns.split(", ")]

    def cell(value: object) -> str:
        if value is None:
            return "NULL"
        return "'" + value.replace("'", "\\'") + "'" if isinstance(value, str) else str(value)

    values = ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)
    table = spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(names)})")
    return table.select(*[F.col(n).cast(t).alias(n) for n, t in zip(names, types)])


def _input_size(spark: SparkSession, path: str) -> tuple[int, int]:
    """Bytes and last change of an input, from the file system's listing."""
    target, fs = file_system(spark, path)
    return fs.getContentSummary(target).getLength(), fs.getFileStatus(target).getModificationTime()


class DerivedLedger(Mapping[str, DataFrame]):
    """The ledger over one data folder; stored tables are written on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str, unit: str | None = None):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self.folder = run_folder(spark, "ledger")
        input_bytes = sum(
            _input_size(spark, f"{self.sf_dir}/{t}.parquet")[0] for t in ("orders", "lineitem", "customer", "supplier")
        )
        self.buckets = min(MOST_BUCKETS, max(FEWEST_BUCKETS, input_bytes // BYTES_PER_BUCKET))
        self.unit = unit or ("year" if input_bytes <= BYTES_BY_YEAR else "month" if input_bytes <= BYTES_BY_MONTH else "day")
        self._built: dict[str, DataFrame] = {}
        self._tables: list[str] = []
        self._registered: dict[str, str] = {}
        self._small: set[str] = set()
        self._namespaces: list[str] = []
        self._views: list[str] = []

    def __getitem__(self, name: str) -> DataFrame:
        return without_layout(self.stored(name), name)

    def stored(self, name: str) -> DataFrame:
        """A table with the columns that say where its rows lie."""
        if name not in self._built:
            if name in STORED:
                self._built[name] = self._store(name)
            elif name in SCANNED:
                derive, key = SCANNED[name]
                dealt = self.legs.repartition(self.buckets * SCANNED_FILES_PER_BUCKET, key)
                self._built[name] = self._store_small(name, derive(dealt))
            elif name in LOOKUPS:
                self._built[name] = literal_table(self.spark, LEDGER_COLUMNS[name], LOOKUPS[name])
            elif name in LEDGER_COLUMNS:
                small = getattr(self, f"_{name}")()
                self._built[name] = self._store_small(name, small) if "settlement" in name.lower() else small
            else:
                raise KeyError(name)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(LEDGER_COLUMNS)

    def __len__(self) -> int:
        return len(LEDGER_COLUMNS)

    def prepare(self) -> None:
        """Write every stored table now."""
        self._store_together([*STORED, *SCANNED])
        for name in self:
            self[name]

    def _store_together(self, names: list[str]) -> None:
        """Write tables a few at a time so their small stages overlap."""
        self.legs, self.windows
        with ThreadPoolExecutor(4) as pool:
            list(pool.map(self.__getitem__, [*names, "settlementSettlementWindow"]))

    def path(self, name: str) -> str:
        """Folder of a stored table, for readers that take a path (streams)."""
        self[name]
        return f"{self.folder}/{name}"

    @cached_property
    def legs(self) -> DataFrame:
        path = f"{self.folder}/legs"
        payment_legs(self.spark, self.sf_dir, self.unit).write.parquet(path)
        return self.spark.read.parquet(path)

    @cached_property
    def windows(self) -> DataFrame:
        """The months that have payments: settlement windows ``w`` starting at ``m``."""
        month = F.date_trunc("month", "ts").cast("timestamp_ntz")
        return self._store_small("windows", self.legs.select(_month_number("ts").alias("w"), month.alias("m")).distinct())

    def _store(self, name: str) -> DataFrame:
        derive, key = STORED[name]
        table = f"clearbook_{self.folder.rsplit('-', 1)[1]}_{name}"
        # Legs are dealt before rows are derived from them where they have the key: one leg is narrower than its rows.
        dealt = key in self.legs.columns
        rows = derive(self.legs.repartition(self.buckets, key) if dealt else self.legs)
        writer = (rows if dealt else rows.repartition(self.buckets, key)).write.mode("overwrite").format("parquet")
        places = PARTITIONED.get(name, ["period"] if "period" in rows.columns else [])
        if places:
            writer = writer.partitionBy(*places)
        writer.bucketBy(self.buckets, key).sortBy(SORTED.get(name, key)).option("path", f"{self.folder}/{name}").saveAsTable(table)
        self._tables.append(table)
        self._registered[name] = table
        return self.spark.table(table)

    def in_namespaces(self) -> tuple[str, dict[str, str]]:
        """The ledger as views of a catalog: the hub's namespace, and that of each table kept elsewhere.

        Exchange payments and rates lie in namespaces of their own, as they belong to other services.
        """
        base = f"clearbook_{self.folder.rsplit('-', 1)[1]}"
        others = {name: f"{base}_{suffix}" for name, suffix in ELSEWHERE.items()}
        for namespace in {base, *others.values()} - set(self._namespaces):
            self.spark.sql(f"CREATE DATABASE {namespace} LOCATION '{self.folder}/{namespace}'")
            self._namespaces.append(namespace)
        self._store_together([*STORED])
        for name in self:
            view = f"{others.get(name, base)}.{name}"
            if view not in self._views:
                self.stored(name)
                source = self._registered.get(name) or f"parquet.`{self._written(name)}`"
                columns = ", ".join(c.split()[0] for c in LEDGER_COLUMNS[name].split(", "))
                self.spark.sql(f"CREATE VIEW {view} AS SELECT {columns} FROM {source}")
                self._views.append(view)
        return base, others

    def _written(self, name: str) -> str:
        """Folder of a small table, written if it only is a plan."""
        path = f"{self.folder}/{name}"
        if name not in self._small:
            self[name].write.mode("overwrite").parquet(path)
            self._small.add(name)
        return path

    def close(self) -> None:
        """Drop the registered tables and namespaces and remove the folder; the next use of the data derives it anew."""
        for namespace in self._namespaces:
            self.spark.sql(f"DROP DATABASE IF EXISTS {namespace} CASCADE")
        for table in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        target, fs = file_system(self.spark, self.folder)
        fs.delete(target, True)
        for key in [k for k, ledger in _LEDGERS.items() if ledger is self]:
            del _LEDGERS[key]

    def _store_small(self, name: str, rows: DataFrame) -> DataFrame:
        path = f"{self.folder}/{name}"
        rows.write.parquet(path)
        self._small.add(name)
        return self.spark.read.parquet(path)

    # The small tables: participants, rates, and whatever follows the windows.

    def _nations(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/nation.parquet")

    def _participant(self) -> DataFrame:
        banks = self._nations().select((F.col("n_nationkey") + 1).alias("participantId"), F.col("n_name").alias("name"))
        virtual = [(100 + r, f"DFSP{c}") for r, c in enumerate(ZONE_CURRENCIES)]
        return banks.unionByName(literal_table(self.spark, LEDGER_COLUMNS["participant"], virtual))

    def _participantCurrency(self) -> DataFrame:
        banks = self._nations().select(
            (F.col("n_nationkey") + 1001).alias("participantCurrencyId"),
            (F.col("n_nationkey") + 1).alias("participantId"),
            _currency("n_regionkey").alias("currencyId"),
        )
        virtual = [(1100 + r, 100 + r, c) for r, c in enumerate(ZONE_CURRENCIES)]
        return banks.unionByName(literal_table(self.spark, LEDGER_COLUMNS["participantCurrency"], virtual))

    def _exchange_channel_rates(self) -> DataFrame:
        rows = [(s * 5 + d, (s + 1) * 1250 + d * 375, 3) for s, d in _zone_pairs()]
        return literal_table(self.spark, LEDGER_COLUMNS["exchange_channel_rates"], rows)

    def _citiExchangeRate(self) -> DataFrame:
        rows = [(s * 5 + d, 7000 + s * 5 + d) for s, d in _zone_pairs() if (s * 5 + d) % 2 == 0]
        return literal_table(self.spark, LEDGER_COLUMNS["citiExchangeRate"], rows)

    def _settlementWindowStateChange(self) -> DataFrame:
        def change(offset: int, state: str, when: Column) -> Column:
            return F.struct(
                (F.col("w") * 2 + offset).alias("settlementWindowStateChangeId"),
                F.col("w").alias("settlementWindowId"),
                F.lit(state).alias("settlementWindowStateId"),
                when.alias("createdDate"),
            )

        opened = change(0, "OPEN", F.col("m"))
        closed = change(1, "CLOSED", F.col("m") + F.make_ym_interval(months=F.lit(1)))
        both = F.when(F.col("w") < OPEN_WINDOW, F.array(opened, closed)).otherwise(F.array(opened))
        return self.windows.select(F.inline(both))

    def _settlementWindow(self) -> DataFrame:
        closed = F.col("w") < OPEN_WINDOW
        return self.windows.select(
            F.col("w").alias("settlementWindowId"),
            (F.col("w") * 2 + F.when(closed, 1).otherwise(0)).alias("currentStateChangeId"),
        )

    def _settlementSettlementWindow(self) -> DataFrame:
        return self.windows.where(F.col("w") < OPEN_WINDOW).select(
            F.expr("w div 3").alias("settlementId"), F.col("w").alias("settlementWindowId")
        )

    def _settlementStateChange(self) -> DataFrame:
        return (
            self["settlementSettlementWindow"]
            .select("settlementId")
            .distinct()
            .select(
                F.col("settlementId").alias("settlementStateChangeId"),
                "settlementId",
                F.when(F.col("settlementId") % 2 == 0, "SETTLED")
                .otherwise("PENDING_SETTLEMENT")
                .alias("settlementStateId"),
                F.lit("2001-12-01 00:00:00").cast("timestamp_ntz").alias("createdDate"),
            )
        )

    def _settlement(self) -> DataFrame:
        return self["settlementStateChange"].select(
            "settlementId", F.col("settlementStateChangeId").alias("currentStateChangeId")
        )


_LEDGERS: dict[tuple, DerivedLedger] = {}


def derived_ledger(spark: SparkSession, sf_dir: str, unit: str | None = None) -> DerivedLedger:
    """The ledger over ``sf_dir``, shared by the queries of one application.

    The key holds the inputs' size and time, so changed inputs give a new ledger.
    """
    inputs = tuple(
        _input_size(spark, f"{sf_dir}/{t}.parquet") for t in ("nation", "customer", "supplier", "orders", "lineitem")
    )
    key = (spark.sparkContext.applicationId, sf_dir, inputs, unit)
    if key not in _LEDGERS:
        _LEDGERS[key] = DerivedLedger(spark, sf_dir, unit)
    return _LEDGERS[key]


def rate_validity(ledger: DerivedLedger) -> DataFrame:
    """One rate per currency pair and month: the month's rate of the pair."""
    rates = ", ".join(
        f"""named_struct('rateId', w * 25 + {s * 5 + d}, 'sourceCurrency', '{ZONE_CURRENCIES[s]}',
        'targetCurrency', '{ZONE_CURRENCIES[d]}', 'rate', {(s + 1) * 1250 + d * 375} + w % 7, 'decimals', 3)"""
        for s, d in _zone_pairs()
    )
    return ledger.windows.select(
        F.expr(f"inline(array({rates}))"),
        F.col("m").alias("validFrom"),
        (F.col("m") + F.make_ym_interval(months=F.lit(1))).alias("validTo"),
    )


def registry_documents(ledger: DerivedLedger) -> DataFrame:
    """One registry document per participant, with its currency and monetary zone."""
    names = F.create_map(*[F.lit(x) for item in ZONE_NAMES.items() for x in item])
    virtual = F.col("participantId") >= 100
    listed = F.struct(F.col("name").alias("dfspId"), F.col("currencyId").alias("description"), "currencyId")
    owners = ledger["participantCurrency"].join(ledger["participant"], "participantId")
    return owners.select(
        F.array(F.struct("currencyId")).alias("currencies"),
        F.array(
            F.struct(F.col("currencyId").alias("monetaryZoneId"), names[F.col("currencyId")].alias("name"))
        ).alias("monetaryZones"),
        F.when(virtual, F.array(listed)).alias("vdfsps"),
        F.when(~virtual, F.array(listed)).alias("dfsps"),
    )
