"""Ledger feeds derived from the driver's TPC-H-style tables.

The mapping is fixed integer/decimal arithmetic over `orders`, `customer`,
`lineitem`, `supplier`, `events` and `part` (see FIXTURES.md section 2), so
the same feeds can be rebuilt in DuckDB for the oracle
(`tieout.sources.fixture_sql`). The feeds are lazy DataFrames over two narrow tables:

* orders⋈customer and lineitem⋈supplier (repeats numbered) are written once
  each; they hold a source row per row, no text that follows from its key;
* a feed is one filter and projection over one of them, so it computes the
  columns and documents that its reader asks for and nothing is cached;
* a document's FX rate is an expression that gives what a look-up in `fx_rate`
  does, so no join stands in the feeds and readers without amounts drop it;
* GL lines are the documents exploded once into a Dr and a Cr line and their
  replayed copies, with the break rules applied as column expressions.
"""

from __future__ import annotations

import datetime as dt
import threading
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tieout.functions.columns import add_days, mint_id, money, pick, qty, rate, to_usd
from tieout.plans.materialize import new_table_dir, write_table
from tieout.sources import reference_data as R
from tieout.sources.schemas import raw_columns

# --- FIXED VALUES of the fixture mapping (FIXTURES.md section 2)
FX_FIRST_DAY = "1995-01-01"
FX_LAST_DAY = "2002-01-31"
FX_MISSING_INR_DAY_OF_YEAR = 100
FX_FALLBACK_RATE = "0.012"
AR_REVENUE_ACCOUNTS = ["4000", "4100", "4200"]
AP_EXPENSE_ACCOUNTS = ["6000", "6100", "6200", "6300", "6400", "6500", "6600", "6900"]
MANUAL_DEBIT_ACCOUNTS = ["6000", "6100", "1400", "2100"]
MANUAL_CONTROL_CREDITS = ["1200", "1300", "2000"]
LIVE_INGESTED_AT = dt.datetime(2024, 2, 1)
REPLAY_INGESTED_AT = dt.datetime(2024, 1, 31)
FIXTURE_INGESTED_AT = dt.datetime(2024, 2, 1)
# added to the document key per repeat of an (l_orderkey, l_linenumber); above every key
# 10 * l_orderkey + 7 and a multiple of 2000, so a repeat keeps the residues of most rules
REPEAT_STEP = 1_000_000_000_000_000
DOCUMENT_COLUMNS = [
    "system", "doc_date", "due_date", "amount", "debit_account", "credit_account", "status", "method", "ref_id", "reason",
    "party", "txn_type", "quantity", "unit_cost", "inv_account", "off_account",
]
CREATED_BY = {"AP": "ap_subledger_feed", "AR": "ar_subledger_feed", "INV": "inv_subledger_feed"}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fixed_ts(value: dt.datetime) -> Column:
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")


def dim_entity(spark: SparkSession) -> DataFrame:
    rows = [(*e, FIXTURE_INGESTED_AT) for e in R.ENTITIES]
    return spark.createDataFrame(
        rows,
        "entity_id INT, entity_code STRING, entity_name STRING, functional_currency STRING, "
        "country STRING, ingested_at TIMESTAMP",
    )


def dim_account(spark: SparkSession) -> DataFrame:
    rows = [
        (i + 1, code, name, typ, parent, ctl, sub, R.ACCOUNTS_EFFECTIVE_FROM, None, FIXTURE_INGESTED_AT)
        for i, (code, name, typ, parent, ctl, sub) in enumerate(R.CHART_OF_ACCOUNTS)
    ]
    return spark.createDataFrame(
        rows,
        "account_id INT, account_code STRING, account_name STRING, account_type STRING, "
        "parent_account_code STRING, is_control_account BOOLEAN, subledger_source STRING, "
        "effective_from DATE, effective_to DATE, ingested_at TIMESTAMP",
    )


#: The formula of `fx_rate` by day of the year modulo 7.
FX_BY_DAY = {
    "USD": [Decimal(1)] * 7,
    "EUR": [Decimal("1.08") + Decimal("0.001") * i for i in range(7)],
    "INR": [Decimal("0.012") + Decimal("0.00001") * i for i in range(7)],
}


def rate_in_table(day: Column, currency: Column) -> Column:
    """What a look-up of a document in `fx_rate` gives: null where the table has no row.

    Rates as literals in place of a join, so a reader that needs no amounts pays nothing.
    """
    inside = day.between(F.lit(FX_FIRST_DAY).cast("date"), F.lit(FX_LAST_DAY).cast("date"))
    doy = F.dayofyear(day)
    of_day = {c: F.get(F.array(*(rate(F.lit(r)) for r in rates)), doy % 7) for c, rates in FX_BY_DAY.items()}
    found = F.when(currency == "USD", of_day["USD"]).when(currency == "EUR", of_day["EUR"]).when(
        (currency == "INR") & (doy != FX_MISSING_INR_DAY_OF_YEAR), of_day["INR"])
    return F.when(inside, found)


def fx_rate(spark: SparkSession) -> DataFrame:
    """One rate per calendar day and currency; INR has a hole on day-of-year 100."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(FX_FIRST_DAY).cast("date"), F.lit(FX_LAST_DAY).cast("date"))).alias("rate_date")
    )
    cur = F.explode(F.array(*[F.lit(c) for c in R.CURRENCIES])).alias("from_currency")
    doy7 = (F.dayofyear("rate_date") % 7).cast("decimal(18,8)")
    out = days.select("rate_date", cur).select(
        "rate_date",
        "from_currency",
        F.lit("USD").alias("to_currency"),
        rate(
            F.when(F.col("from_currency") == "USD", F.lit(1).cast("decimal(18,8)"))
            .when(F.col("from_currency") == "EUR", F.lit("1.08").cast("decimal(18,8)") + F.lit("0.001").cast("decimal(18,8)") * doy7)
            .otherwise(F.lit("0.012").cast("decimal(18,8)") + F.lit("0.00001").cast("decimal(18,8)") * doy7)
        ).alias("rate"),
        _fixed_ts(FIXTURE_INGESTED_AT).alias("ingested_at"),
    )
    return out.filter(~((F.col("from_currency") == "INR") & (F.dayofyear("rate_date") == FX_MISSING_INR_DAY_OF_YEAR)))


def _functional_currency(entity_id: Column) -> Column:
    return pick(entity_id, [e[3] for e in R.ENTITIES], base=1)


def _doc_currency(k: Column, entity_id: Column) -> Column:
    return F.when(k % 5 != 0, _functional_currency(entity_id)).otherwise(pick(_div("k", 5) % 3, R.CURRENCIES))


def _div(name: str, n: int) -> Column:
    """Integer division (SQL `div`, bigint result) of a named column."""
    return F.expr(f"`{name}` div {n}")


class Fixture:
    """Lazily built ledger feeds for one (session, sf_dir); the two base tables are written once."""

    def __init__(self, spark: SparkSession, sf_dir: str, persist: bool = True):
        self.spark = spark
        self.sf_dir = sf_dir
        self._persist = persist
        self._cache: dict[str, DataFrame] = {}
        self._lock = threading.RLock()

    def _memo(self, key: str, build, persist: bool = False) -> DataFrame:
        with self._lock:  # feeds are asked for from several threads
            if key not in self._cache:
                df = build()
                if persist and self._persist:
                    df = write_table(df, new_table_dir(self.spark, f"fixture-{key}"))
                self._cache[key] = df
            return self._cache[key]

    # ---------------------------------------------------------------- base rows
    def od(self) -> DataFrame:
        def build():
            o = _read(self.spark, self.sf_dir, "orders").select(
                "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"
            )
            c = _read(self.spark, self.sf_dir, "customer").select("c_custkey", "c_nationkey")
            return o.join(c, o.o_custkey == c.c_custkey, "inner").select(
                F.col("o_orderkey").alias("k"),
                (F.col("c_nationkey") % 3 + 1).cast("int").alias("entity_id"),
                F.to_date("o_orderdate").alias("dt"),
                F.col("o_orderstatus").alias("st"),
                money("o_totalprice").alias("px"),
                F.col("o_custkey").alias("party"),
            )

        return self._memo("od", build, persist=True)

    def li(self) -> DataFrame:
        def build():
            l = _read(self.spark, self.sf_dir, "lineitem")
            s = _read(self.spark, self.sf_dir, "supplier").select("s_suppkey", "s_nationkey")
            # (l_orderkey, l_linenumber) is not unique: repeats are numbered in a
            # total order and the number goes into the document key, so every
            # row becomes its own document
            from pyspark.sql.window import Window as W

            w = W.partitionBy("l_orderkey", "l_linenumber").orderBy(
                F.col("l_shipdate").desc(), "l_partkey", "l_suppkey", "l_quantity",
                "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
            )
            l1 = l.withColumn("_rn", F.row_number().over(w).cast("bigint"))
            return l1.join(s, l1.l_suppkey == s.s_suppkey, "inner").select(
                (F.col("l_orderkey") * 10 + F.col("l_linenumber") + (F.col("_rn") - 1) * REPEAT_STEP).alias("k"),
                (F.col("s_nationkey") % 3 + 1).cast("int").alias("entity_id"),
                F.to_date("l_shipdate").alias("dt"),
                F.col("l_returnflag").alias("rf"),
                F.col("l_linestatus").alias("ls"),
                money("l_extendedprice").alias("px"),
                F.col("l_suppkey").alias("party"),
                F.col("l_partkey").alias("item"),
                F.col("l_quantity").alias("q"),
                F.col("l_extendedprice").alias("xp"),
            )

        return self._memo("li", build, persist=True)

    # ---------------------------------------------------------------- documents
    def _feeds(self) -> dict[str, tuple[str, Column | None, dict[str, Column]]]:
        """Per feed: the base table, the rows that give a document, the document's own columns."""
        k = F.col("k")
        null_s = F.lit(None).cast("string")
        null_d, null_q = F.lit(None).cast("date"), F.lit(None).cast("decimal(18,4)")
        common_od = dict(
            party=mint_id("CUST", F.col("party"), 7),
            txn_type=null_s, quantity=null_q, unit_cost=null_q,
            inv_account=null_s, off_account=null_s,
        )
        ar_inv = dict(
            system=F.lit("AR"), doc_date=F.col("dt"),
            due_date=add_days(F.col("dt"), 15 + k % 45), amount=F.col("px"),
            debit_account=F.lit("1200"), credit_account=pick(k % 3, AR_REVENUE_ACCOUNTS),
            status=F.when(F.col("st") == "O", "OPEN").when(F.col("st") == "F", "PAID")
            .when(F.col("st") == "P", "WRITTEN_OFF"),
            method=null_s, ref_id=null_s, reason=null_s, **common_od,
        )
        ar_rcp = dict(
            system=F.lit("AR"), doc_date=add_days(F.col("dt"), 5 + k % 45),
            due_date=null_d, amount=F.col("px"),
            debit_account=F.lit("1000"), credit_account=F.lit("1200"),
            status=null_s, method=pick(k % 4, R.PAYMENT_METHODS),
            ref_id=mint_id("AR-INV", k), reason=null_s, **common_od,
        )
        ap_acc = dict(
            system=F.lit("AP"), doc_date=F.col("dt"),
            due_date=add_days(F.col("dt"), 15 + k % 20), amount=F.col("px"),
            debit_account=pick(k % 8, AP_EXPENSE_ACCOUNTS), credit_account=F.lit("2000"),
            status=null_s, method=null_s, ref_id=null_s, reason=null_s, **common_od,
        )
        ar_cm = dict(
            system=F.lit("AR"), doc_date=add_days(F.col("dt"), 1 + k % 29),
            due_date=null_d, amount=money(F.col("px") * F.lit("0.50").cast("decimal(3,2)")),
            debit_account=pick(k % 3, AR_REVENUE_ACCOUNTS), credit_account=F.lit("1200"),
            status=null_s, method=null_s, ref_id=mint_id("AR-INV", k),
            reason=pick(k % 3, R.CREDIT_MEMO_REASONS), **common_od,
        )
        rf, ls = F.col("rf"), F.col("ls")
        cents = F.round(F.col("xp") * 100).cast("bigint")
        qn = F.col("q").cast("bigint")
        unit_cost = qty(
            F.when(qn > 0, (cents - cents % qn) / qn).otherwise(F.lit(0)).cast("decimal(18,0)")
            * F.lit("0.01").cast("decimal(3,2)")
        )
        common_li = dict(party=mint_id("VEND", F.col("party"), 7), reason=null_s)
        ap_inv = dict(
            system=F.lit("AP"), doc_date=F.col("dt"),
            due_date=add_days(F.col("dt"), 15 + k % 45), amount=F.col("px"),
            debit_account=pick(k % 8, AP_EXPENSE_ACCOUNTS), credit_account=F.lit("2000"),
            status=F.when(ls == "F", "PAID").when(ls == "O", "OPEN"), method=null_s, ref_id=null_s,
            txn_type=null_s, quantity=null_q, unit_cost=null_q, inv_account=null_s, off_account=null_s,
            **common_li,
        )
        ap_pay = dict(
            system=F.lit("AP"), doc_date=add_days(F.col("dt"), 5 + k % 40),
            due_date=null_d, amount=F.col("px"),
            debit_account=F.lit("2000"), credit_account=F.lit("1000"),
            status=null_s, method=pick(k % 4, R.PAYMENT_METHODS), ref_id=mint_id("AP-INV", k),
            txn_type=null_s, quantity=null_q, unit_cost=null_q, inv_account=null_s, off_account=null_s,
            **common_li,
        )
        inv_amount = F.when(k % 2000 == 4, F.lit(0).cast("decimal(18,2)")).otherwise(F.col("px"))
        is_neg_adj = (rf == "R") & (ls == "F")
        inv_type = F.when(rf == "A", "RECEIPT").otherwise("ADJUSTMENT")
        inv_type = F.when((rf == "A") & (ls == "F"), "COGS").otherwise(inv_type)
        inv_col = F.when((rf == "A") & (ls == "F"), F.lit("5000")).otherwise(F.lit("1300"))
        off_col = F.when(rf == "A", F.when(ls == "F", F.lit("1300")).otherwise(F.lit("2000"))).otherwise(
            F.lit("6900")
        )
        inv = dict(
            system=F.lit("INV"), doc_date=F.col("dt"), due_date=null_d,
            amount=F.when(is_neg_adj, -inv_amount).otherwise(inv_amount),
            debit_account=F.when(is_neg_adj, off_col).otherwise(inv_col),
            credit_account=F.when(is_neg_adj, inv_col).otherwise(off_col),
            status=null_s, method=null_s, ref_id=mint_id("ITEM", F.col("item"), 7),
            txn_type=inv_type, quantity=qty(F.col("q")), unit_cost=unit_cost,
            inv_account=inv_col, off_account=off_col, **common_li,
        )
        return {
            "AR-INV": ("od", None, ar_inv),
            "AR-RCP": ("od", F.col("st") == "F", ar_rcp),
            "AP-ACC": ("od", k % 30 == 0, ap_acc),
            "AR-CM": ("od", k % 50 == 1, ar_cm),
            "AP-INV": ("li", rf == "N", ap_inv),
            "AP-PAY": ("li", (rf == "N") & (ls == "F"), ap_pay),
            "INV": ("li", rf.isin("A", "R"), inv),
        }

    def _docs(self, feed: str) -> DataFrame:
        """The documents of one feed, with FX resolved: a filter and a projection of its base table."""
        base, wanted, columns = self._feeds()[feed]
        rows = self.od() if base == "od" else self.li()
        if wanted is not None:
            rows = rows.filter(wanted)
        k = F.col("k")
        docs = rows.select("k", "entity_id", F.lit(feed).alias("feed"), *[columns[c].alias(c) for c in DOCUMENT_COLUMNS])
        docs = docs.withColumn(
            "currency",
            F.when(F.col("system") == "INV", F.lit("USD")).otherwise(_doc_currency(k, F.col("entity_id"))),
        )
        fxr = F.when(F.col("system") == "INV", F.lit(1).cast("decimal(18,8)")).otherwise(F.coalesce(
            rate_in_table(F.col("doc_date"), F.col("currency")), F.lit(FX_FALLBACK_RATE).cast("decimal(18,8)")))
        return (
            docs.withColumn("fx_rate", rate(fxr))
            .withColumn("amount_usd", F.when(F.col("fx_rate") == 1, F.col("amount")).otherwise(
                to_usd(F.col("amount"), F.col("fx_rate"))))
            .withColumn("doc_id", mint_id(F.col("feed"), k))
        )

    def documents(self, *feeds: str) -> DataFrame:
        """Every sub-ledger document once (of the feeds named, else of all)."""
        return reduce(DataFrame.unionByName, (self._docs(f) for f in feeds or self._feeds()))

    def _sl_docs(self, feed: str) -> DataFrame:
        # the sub-ledger side loses documents with k % 1000 = 9
        return self.documents(feed).filter(F.col("k") % 1000 != 9)

    # ---------------------------------------------------------------- raw feeds
    def ap_invoices(self) -> DataFrame:
        d = self._sl_docs("AP-INV")
        return d.select(
            F.col("doc_id").alias("invoice_id"), F.col("party").alias("vendor_id"), "entity_id",
            F.col("doc_date").alias("invoice_date"), F.col("doc_date").alias("posting_date"), "due_date",
            "currency", F.col("amount").alias("amount_currency"), "amount_usd", "fx_rate",
            F.col("debit_account").alias("expense_account_code"),
            F.col("credit_account").alias("control_account_code"), "status",
            F.concat(F.lit("Vendor invoice "), F.col("doc_id")).alias("description"),
            _fixed_ts(FIXTURE_INGESTED_AT).alias("ingested_at"),
        )

    def ap_payments(self) -> DataFrame:
        d = self._sl_docs("AP-PAY")
        return d.select(
            F.col("doc_id").alias("payment_id"), F.col("ref_id").alias("invoice_id"), "entity_id",
            F.col("doc_date").alias("payment_date"), F.col("doc_date").alias("posting_date"),
            "currency", F.col("amount").alias("amount_currency"), "amount_usd", "fx_rate",
            F.col("credit_account").alias("cash_account_code"),
            F.col("debit_account").alias("control_account_code"), "method",
            _fixed_ts(FIXTURE_INGESTED_AT).alias("ingested_at"),
        )

    def ap_accruals(self) -> DataFrame:
        d = self._sl_docs("AP-ACC")
        return d.select(
            F.col("doc_id").alias("accrual_id"), "entity_id",
            F.col("doc_date").alias("accrual_date"), F.col("doc_date").alias("posting_date"),
            F.col("due_date").alias("reversal_date"),
            "currency", F.col("amount").alias("amount_currency"), "amount_usd", "fx_rate",
            F.col("debit_account").alias("expense_account_code"),
            F.col("credit_account").alias("control_account_code"),
            F.lit("Month-end accrual").alias("description"),
            _fixed_ts(FIXTURE_INGESTED_AT).alias("ingested_at"),
        )

    def ar_invoices(self) -> DataFrame:
        d = self._sl_docs("AR-INV")
        return d.select(
            F.col("doc_id").alias("invoice_id"), F.col("party").alias("customer_id"), "entity_id",
            F.col("doc_date").alias("invoice_date"), F.col("doc_date").alias("posting_date"), "due_date",
            "currency", F.col("amount").alias("amount_currency"), "amount_usd", "fx_rate",
            F.col("credit_account").alias("revenue_account_code"),
            F.col("debit_account").alias("control_account_code"), "status",
            F.concat(F.lit("Customer invoice "), F.col("doc_id")).alias("description"),
            _fixed_ts(FIXTURE_INGESTED_AT).alias("ingested_at"),
        )

    def ar_receipts(self) -> DataFrame:
        d = self._sl_docs("AR-RCP")
        return d.select(
            F.col("doc_id").alias("receipt_id"), F.col("ref_id").alias("invoice_id"), "entity_id",
            F.col("doc_date").alias("receipt_date"), F.col("doc_date").alias("posting_date"),
            "currency", F.col("amount").alias("amount_currency"), "amount_usd", "fx_rate",
            F.col("debit_account").alias("cash_account_code"),
            F.col("credit_account").alias("control_account_code"), "method",
            _fixed_ts(FIXTURE_INGESTED_AT).alias("ingested_at"),
        )

    def ar_credit_memos(self) -> DataFrame:
        d = self._sl_docs("AR-CM")
        return d.select(
            F.col("doc_id").alias("memo_id"), F.col("ref_id").alias("invoice_id"), "entity_id",
            F.col("doc_date").alias("memo_date"), F.col("doc_date").alias("posting_date"),
            "currency", F.col("amount").alias("amount_currency"), "amount_usd", "fx_rate", "reason",
            F.col("debit_account").alias("revenue_account_code"),
            F.col("credit_account").alias("control_account_code"),
            _fixed_ts(FIXTURE_INGESTED_AT).alias("ingested_at"),
        )

    def inv_transactions(self) -> DataFrame:
        d = self._sl_docs("INV")
        return d.select(
            F.col("doc_id").alias("txn_id"), F.col("ref_id").alias("item_id"), "entity_id",
            F.col("doc_date").alias("txn_date"), F.col("doc_date").alias("posting_date"), "txn_type",
            "quantity", F.col("unit_cost").alias("unit_cost_usd"), F.col("amount").alias("amount_usd"),
            F.col("inv_account").alias("inventory_account_code"),
            F.col("off_account").alias("offset_account_code"),
            F.concat(F.lit("INV "), F.col("txn_type"), F.lit(" "), F.col("doc_id")).alias("description"),
            _fixed_ts(FIXTURE_INGESTED_AT).alias("ingested_at"),
        )

    # ---------------------------------------------------------------- GL
    def _posted_docs(self) -> DataFrame:
        return self.documents("AP-INV", "AP-PAY", "AR-INV", "AR-RCP", "INV")

    def gl_feed_lines(self) -> DataFrame:
        """GL lines of the sub-ledger feeds, break rules applied: live lines and replayed (older, 1.00 higher) copies."""
        d = self._posted_docs().filter(F.col("k") % 333 != 5)
        k = F.col("k")
        # live lines are copies 1 and 2, replays of them 3 and 4
        live, all_copies = F.array(F.lit(1), F.lit(2)), F.array(*map(F.lit, (1, 2, 3, 4)))
        d = d.select("*", F.explode(F.when(k % 40 == 3, all_copies).otherwise(live)).alias("_copy"))
        replayed = F.col("_copy") > 2
        d = d.withColumn("journal_line_id", F.when(replayed, F.col("_copy") - 2).otherwise(F.col("_copy")))
        ln = F.col("journal_line_id")
        cent = F.lit("0.01").cast("decimal(3,2)")
        amt_delta = F.when(
            (k % 200 == 21) & (ln == _div("k", 200) % 2 + 1), cent * (_div("k", 200) % 50 + 1).cast("decimal(10,0)")
        ).otherwise(F.lit(0).cast("decimal(3,2)"))
        fx_delta = F.when(
            (F.col("currency") != "USD") & (k % 100 == 63) & (ln == _div("k", 100) % 2 + 1),
            cent * (_div("k", 100) % 5 + 1).cast("decimal(10,0)"),
        ).otherwise(F.lit(0).cast("decimal(3,2)"))
        shift = F.when(
            (k % 50 == 7) & (ln == _div("k", 50) % 2 + 1), F.when(_div("k", 50) % 10 < 3, 2).otherwise(1)
        ).otherwise(0)
        base = F.abs(F.col("amount_usd"))
        broken = (k % 200 == 21) | ((F.col("currency") != "USD") & (k % 100 == 63))
        d = d.withColumn("_live", F.when(broken, money(base + amt_delta + fx_delta)).otherwise(base))
        one = F.lit("1.00").cast("decimal(3,2)")
        d = d.withColumn("_value", F.when(replayed, money(F.col("_live") + one)).otherwise(F.col("_live")))
        value = F.col("_value")
        zero = F.lit(0).cast("decimal(18,2)")
        desc = (
            F.when(F.col("feed") == "AP-INV", F.concat(F.lit("AP invoice "), F.col("doc_id")))
            .when(F.col("feed") == "AP-PAY", F.concat(F.lit("AP payment "), F.col("doc_id")))
            .when(F.col("feed") == "AR-INV", F.concat(F.lit("AR invoice "), F.col("doc_id")))
            .when(F.col("feed") == "AR-RCP", F.concat(F.lit("AR receipt "), F.col("doc_id")))
            .otherwise(F.concat(F.lit("INV "), F.col("txn_type"), F.lit(" "), F.col("doc_id")))
        )
        return d.select(
            F.concat(F.lit("GL-"), F.col("doc_id")).alias("journal_id"),
            ln.cast("int").alias("journal_line_id"),
            "entity_id",
            F.col("doc_date").alias("business_date"),
            add_days(F.col("doc_date"), shift).alias("posting_date"),
            F.when(ln == 1, F.col("debit_account")).otherwise(F.col("credit_account")).alias("account_code"),
            F.when(ln == 1, value).otherwise(zero).alias("debit_usd"),
            F.when(ln == 2, value).otherwise(zero).alias("credit_usd"),
            "currency",
            money(F.when(F.col("system") == "INV", F.abs(F.col("amount"))).otherwise(F.col("amount"))).alias(
                "amount_currency"
            ),
            "fx_rate",
            F.col("system").alias("source_system"),
            F.col("doc_id").alias("source_doc_id"),
            desc.alias("description"),
            (
                F.when(F.col("system") == "AP", F.lit(CREATED_BY["AP"]))
                .when(F.col("system") == "AR", F.lit(CREATED_BY["AR"]))
                .otherwise(F.lit(CREATED_BY["INV"]))
            ).alias("created_by"),
            F.when(replayed, _fixed_ts(REPLAY_INGESTED_AT)).otherwise(_fixed_ts(LIVE_INGESTED_AT)).alias("ingested_at"),
        )

    def manual_lines(self) -> DataFrame:
        """Manual journal entries from events, plus suspense clearing reversals."""
        ev = _read(self.spark, self.sf_dir, "events")
        e = F.col("event_id")
        credit = F.when(e % 100 == 0, pick(_div("event_id", 100) % 3, MANUAL_CONTROL_CREDITS)).otherwise(
            F.when(e % 97 == 0, F.lit("9999")).otherwise(F.lit("1000"))
        )
        base = ev.select(
            e.alias("event_id"),
            (F.col("user_id") % 3 + 1).cast("int").alias("entity_id"),
            F.to_date("ts").alias("d"),
            money("value").alias("amount"),
            pick(e % 4, MANUAL_DEBIT_ACCOUNTS).alias("dr"),
            credit.alias("cr"),
            F.lit("GL-MJE").alias("prefix"),
            F.lit("Manual journal entry").alias("descr"),
        )
        clearing = base.filter((F.col("cr") == "9999") & (F.col("entity_id") != 3)).select(
            "event_id", "entity_id", add_days(F.col("d"), 1).alias("d"), "amount",
            F.lit("9999").alias("dr"), F.lit("1000").alias("cr"), F.lit("GL-MJR").alias("prefix"),
            F.lit("Suspense clearing").alias("descr"),
        )
        both = base.unionByName(clearing)
        line = F.explode(F.array(F.lit(1), F.lit(2))).alias("journal_line_id")
        both = both.select("*", line)
        ln = F.col("journal_line_id")
        zero = F.lit(0).cast("decimal(18,2)")
        jid = mint_id(F.col("prefix"), F.col("event_id"))
        return both.select(
            jid.alias("journal_id"),
            ln.cast("int").alias("journal_line_id"),
            "entity_id",
            F.col("d").alias("business_date"),
            F.col("d").alias("posting_date"),
            F.when(ln == 1, F.col("dr")).otherwise(F.col("cr")).alias("account_code"),
            F.when(ln == 1, F.col("amount")).otherwise(zero).alias("debit_usd"),
            F.when(ln == 2, F.col("amount")).otherwise(zero).alias("credit_usd"),
            F.lit("USD").alias("currency"),
            F.col("amount").alias("amount_currency"),
            F.lit(1).cast("decimal(18,8)").alias("fx_rate"),
            F.lit("MANUAL").alias("source_system"),
            jid.alias("source_doc_id"),
            F.col("descr").alias("description"),
            F.lit("j.controller").alias("created_by"),
            _fixed_ts(LIVE_INGESTED_AT).alias("ingested_at"),
        )

    def gl_journal(self) -> DataFrame:
        """Raw GL with replayed copies: what lands in raw.gl_journal."""
        return self._memo("gl_journal", lambda: self.gl_feed_lines().unionByName(self.manual_lines()).select(
            *raw_columns("gl_journal")))

    def breaks_log(self) -> DataFrame:
        """The injected-break log implied by the GL rules (one row per injected break)."""
        d = self._posted_docs()
        k = F.col("k")
        jid = F.concat(F.lit("GL-"), F.col("doc_id"))
        cent = F.lit("0.01").cast("decimal(3,2)")
        rows = F.array(
            F.when(k % 333 == 5, F.struct(F.lit(-1).alias("l"), F.lit("missing_gl_posting").alias("c"),
                                            F.lit("entry not posted").alias("x"))),
            F.when((k % 1000 == 9), F.struct(F.lit(-1).alias("l"), F.lit("missing_sl_posting").alias("c"),
                                               F.lit("document not in sub-ledger").alias("x"))),
            F.when((k % 333 != 5) & (k % 50 == 7), F.struct(
                (_div("k", 50) % 2 + 1).cast("int").alias("l"), F.lit("timing_diff").alias("c"),
                F.concat(F.lit("posting_date +"), F.when(_div("k", 50) % 10 < 3, F.lit("2")).otherwise(F.lit("1")),
                         F.lit("d")).alias("x"))),
            F.when((k % 333 != 5) & (k % 200 == 21), F.struct(
                (_div("k", 200) % 2 + 1).cast("int").alias("l"), F.lit("amount_mismatch").alias("c"),
                F.concat(F.lit("amount +"), (cent * (_div("k", 200) % 50 + 1).cast("decimal(10,0)")).cast("string")
                         ).alias("x"))),
            F.when((k % 333 != 5) & (F.col("currency") != "USD") & (k % 100 == 63), F.struct(
                (_div("k", 100) % 2 + 1).cast("int").alias("l"), F.lit("fx_rounding").alias("c"),
                F.concat(F.lit("amount +"), (cent * (_div("k", 100) % 5 + 1).cast("decimal(10,0)")).cast("string")
                         ).alias("x"))),
            F.when((k % 333 != 5) & (k % 40 == 3), F.struct(F.lit(-1).alias("l"), F.lit("replayed_line").alias("c"),
                                                             F.lit("older copy ingested").alias("x"))),
        )
        feed = d.select(jid.alias("journal_id"), F.explode(rows).alias("b")).filter(F.col("b").isNotNull())
        feed = feed.select(
            "journal_id", F.col("b.l").cast("int").alias("journal_line_id"),
            F.col("b.c").alias("break_class"), F.col("b.x").alias("detail"),
        )
        man = self.manual_lines().filter(
            (F.col("journal_line_id") == 2) & F.col("account_code").isin(*MANUAL_CONTROL_CREDITS)
            & F.col("journal_id").startswith("GL-MJE")
        ).select(
            "journal_id", "journal_line_id", F.lit("unauthorized_manual_je").alias("break_class"),
            F.concat(F.lit("manual credit to control account "), F.col("account_code")).alias("detail"),
        )
        return feed.unionByName(man)

    # ---------------------------------------------------------------- extras
    def part_tree(self) -> DataFrame:
        """`part` as a deep account tree: parent = key div 10, keys 0..9 are roots."""
        p = _read(self.spark, self.sf_dir, "part").select("p_partkey", "p_name", "p_type")
        kk = F.col("p_partkey")
        return p.select(
            kk.cast("string").alias("account_code"),
            F.col("p_name").alias("account_name"),
            F.col("p_type").alias("account_type"),
            F.when(kk >= 10, _div("p_partkey", 10).cast("bigint").cast("string")).alias("parent_account_code"),
            F.lit(False).alias("is_control_account"),
            F.lit(None).cast("string").alias("subledger_source"),
        )

    def raw(self, table: str) -> DataFrame:
        if table == "dim_entity":
            return dim_entity(self.spark)
        if table == "dim_account":
            return dim_account(self.spark)
        if table == "fx_rate":
            return fx_rate(self.spark)
        return getattr(self, table)()

    def raw_tables(self) -> dict[str, DataFrame]:
        from tieout.sources.schemas import RAW_TABLES

        return {t: self.raw(t) for t in RAW_TABLES}


_FIXTURES: dict[tuple[int, str], Fixture] = {}


def fixture(spark: SparkSession, sf_dir: str) -> Fixture:
    """One Fixture per (session, sf_dir), so shared frames are built once."""
    key = (id(spark), sf_dir)
    fx = _FIXTURES.get(key)
    if fx is None or fx.spark is not spark:
        fx = Fixture(spark, sf_dir)
        _FIXTURES[key] = fx
    return fx
