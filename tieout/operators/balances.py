"""Daily trial balances and the account hierarchy walk."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tieout.functions.columns import money_sum
from tieout.plans.broadcast import checked_broadcast
from tieout.plans.materialize import new_table_dir, write_table

TB_KEYS = ["entity_id", "account_code", "posting_date"]


def trial_balance(lines: DataFrame) -> DataFrame:
    """Daily debits, credits, net (= credit - debit) and running balance.

    Shuffle 1 aggregates lines to (entity, account, day) with map-side partial
    sums, so a hot account is pre-aggregated before it moves. The running sum
    then runs per (entity, account) over at most one row per calendar day,
    whatever the line volume.
    """
    daily = lines.groupBy(*TB_KEYS).agg(
        money_sum(F.sum("debit_usd")).alias("daily_debits_usd"),
        money_sum(F.sum("credit_usd")).alias("daily_credits_usd"),
        money_sum(F.sum(F.col("credit_usd") - F.col("debit_usd"))).alias("daily_net_usd"),
    )
    w = W.partitionBy("entity_id", "account_code").orderBy("posting_date").rowsBetween(
        W.unboundedPreceding, W.currentRow
    )
    return daily.withColumn("running_balance_usd", money_sum(F.sum("daily_net_usd").over(w)))


#: A pointer target taken by more nodes than this is a hot parent; its readers are spread by salt.
HOT_POINTERS = 100_000
SALTS = 64


def account_hierarchy(accounts: DataFrame, hot_pointers: int = HOT_POINTERS) -> DataFrame:
    """Parent links resolved to the roots: level (0 = root), root_code, '/'-joined path.

    Pointer doubling: every account keeps a pointer to an ancestor, its distance and the codes from
    below that ancestor down to itself. Each round replaces the pointer by the pointer's own one and
    joins the pieces, so distances double and a chain of n accounts takes about log2(n) rounds of
    one join each, where a walk level by level takes n. Only accounts that don't point at a root yet
    are joined; the others are written once and left alone.

    An orphan's pointer leaves the table, which drops it. A cycle shows in about log2(its length)
    rounds: its least code then stands ahead of itself, and goes with all accounts that have it as
    the least code ahead; what hangs below them is dropped like orphans. So pieces never run round
    a cycle more than twice. Both are left out; `unreached_accounts` reports them.

    A parent with very many children is a hot join key: pointers taken by more than `hot_pointers`
    accounts (counted with partial sums) are repeated under SALTS salts and their readers dealt over
    them. Every round is a written table, so a lost executor re-reads files. `account_code` is the key.
    """
    spark = accounts.sparkSession

    def kept(df: DataFrame) -> DataFrame:
        return write_table(df, new_table_dir(spark, "hierarchy"))

    is_root = F.col("parent_account_code").isNull()
    now = kept(accounts.select(
        F.col("account_code").alias("_node"),
        F.coalesce("parent_account_code", "account_code").alias("_at"),
        is_root.alias("_done"),
        F.when(is_root, 0).otherwise(1).cast("long").alias("_far"),
        F.col("parent_account_code").alias("_least"),  # least code ahead, up to the pointer
        F.col("account_code").cast("string").alias("_piece"),
    ))
    done, todo = [now.filter("_done")], now.filter("NOT _done")
    while not todo.isEmpty():
        cycles = kept(todo.filter("_node = _least").select("_least"))
        if not cycles.isEmpty():
            todo = kept(todo.join(cycles, "_least", "left_anti"))
        hot = kept(todo.groupBy("_at").count().filter(F.col("count") > hot_pointers).select("_at", F.lit(True).alias("_hot")))
        pointers = reduce(DataFrame.unionByName, done).unionByName(todo).select(
            F.col("_node").alias("_at"), F.col("_at").alias("_next"), F.col("_done").alias("_root"),
            F.col("_far").alias("_more"), F.col("_least").alias("_low"), F.col("_piece").alias("_above"),
        )
        if hot.isEmpty():
            met = todo.join(pointers, "_at")
        else:
            marks = checked_broadcast(hot)  # at most one row per hot_pointers accounts
            salt = F.when(F.col("_hot"), F.pmod(F.xxhash64("_node"), F.lit(SALTS))).otherwise(0)
            copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
            readers = todo.join(marks, "_at", "left").withColumn("_salt", salt.cast("int")).drop("_hot")
            met = readers.join(pointers.join(marks, "_at", "left").withColumn("_salt", F.explode(copies)).drop("_hot"), ["_at", "_salt"])
        now = kept(met.select(
            "_node", F.col("_next").alias("_at"), F.col("_root").alias("_done"),
            (F.col("_far") + F.col("_more")).alias("_far"), F.least("_least", "_low").alias("_least"),
            F.concat("_above", F.lit("/"), "_piece").alias("_piece"),
        ))
        done.append(now.filter("_done"))
        todo = now.filter("NOT _done")
    found = reduce(DataFrame.unionByName, done).select(
        "_node", F.col("_far").cast("int").alias("level"), F.col("_at").alias("root_code"), F.col("_piece").alias("path"))
    return accounts.join(found, F.col("account_code") == F.col("_node")).drop("_node")


def unreached_accounts(accounts: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """Accounts the walk never reached (orphans and cycles)."""
    return accounts.join(hierarchy.select("account_code"), "account_code", "left_anti")
