"""Operator 9, chat formatting: cumulative-snapshot collapse.

Logged conversations often repeat: each snapshot holds all turns so far. Every
turn gets a hash of its place, role and text; the hash of a prefix is the XOR of
its turns' hashes (128 bits), so it can be rolled along a conversation and summed
up map-side. A conversation whose whole hash is a proper prefix of another one is
dropped by an anti-join; of equal conversations that with the smallest id stays.
What remains is rendered, role by role, between turn marks. Texts are shuffled when
turns get their places and hashes, which are kept as files, and when the conversations
that remain are put together; all between moves hashes only.

No conversation is gathered into one task: places and prefix hashes are found in
blocks of ``BLOCK`` turns, whose counts and hashes are rolled up before, and the
rendered text comes in parts of at most ``PART`` turns.

Defined cases: null roles and texts count as empty; exactly repeated rows are one
turn; turns of equal number follow by role, then text; null turns come last; rows
without a conversation id form one conversation with a null id (which loses to
any equal one); an empty table gives no rows. Turn marks inside texts are broken
up, so no text can open or close a turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import keep
from .common import query, read_columns

BLOCK = 256
PART = 256
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


_KEY = ["conv", "none"]  # the id as text, and whether there is none: keys without nulls, so that one shuffle serves all steps


def numbered_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, conv, none, block, k, role, text, h1, h2, last``: place from 1, hashes of a turn, whether nothing follows."""
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).distinct().select(
        "*", F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), F.col("conv_id").isNull().alias("none"),
        F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit((1 << 63) - 1)).alias("block"))
    counts = rows.groupBy(*_KEY, "block").agg(F.count("*").alias("n"))
    along = Window.partitionBy(*_KEY).orderBy("block")
    starts = counts.select(
        *_KEY, "block", F.coalesce(F.sum("n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"),
        F.lead("block").over(along).isNull().alias("last_block"))
    inside = Window.partitionBy(*_KEY, "block").orderBy(F.asc_nulls_last("turn"), "role", "text")
    return rows.join(starts, [*_KEY, "block"]).select(
        "conv_id", *_KEY, "block", "role", "text", (F.col("start") + F.row_number().over(inside)).alias("k"),
        (F.col("last_block") & F.lead("role").over(inside).isNull()).alias("last"),
    ).select("*", F.xxhash64("k", "role", "text").alias("h1"), F.xxhash64(F.lit("second"), "text", "role", "k").alias("h2"))


def prefix_hashes(numbered: DataFrame) -> DataFrame:
    """``conv_id, conv, none, k, last, p1, p2``: the hash of each prefix, from hashes of turns alone."""
    hashed = numbered.select("conv_id", *_KEY, "block", "k", "last", "h1", "h2")
    sums = hashed.groupBy(*_KEY, "block").agg(F.bit_xor("h1").alias("s1"), F.bit_xor("h2").alias("s2"))
    before = Window.partitionBy(*_KEY).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(*_KEY, "block", *(F.coalesce(F.bit_xor(s).over(before), F.lit(0)).alias(s) for s in ("s1", "s2")))
    rolling = Window.partitionBy(*_KEY, "block").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    return hashed.join(carried, [*_KEY, "block"]).select(
        "conv_id", *_KEY, "k", "last",
        F.col("s1").bitwiseXOR(F.bit_xor("h1").over(rolling)).alias("p1"),
        F.col("s2").bitwiseXOR(F.bit_xor("h2").over(rolling)).alias("p2"))


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """``conv, none`` of conversations that no longer one begins with, one of each set of equals."""
    whole = prefixes.where("last").groupBy("k", "p1", "p2").agg(F.min(F.struct("none", "conv_id", "conv")).alias("least"))
    proper = prefixes.where("not last").select("k", "p1", "p2").distinct()
    return whole.join(proper, ["k", "p1", "p2"], "left_anti").select("least.conv", "least.none")


def rendered(role: Column, text: Column) -> Column:
    def clean(x: Column) -> Column:
        return F.regexp_replace(x, r"<\|(im_start|im_end)\|>", "< |$1| >")

    return F.concat(F.lit(OPEN), clean(role), F.lit("\n"), clean(text), F.lit(CLOSE + "\n"))


def format_chats(turns: DataFrame) -> DataFrame:
    """``conv_id, part, n_turns, text``: the rendered parts of the maximal conversations."""
    numbered = keep(numbered_turns(turns))  # the texts are placed once; what follows reads hashes, the last step texts
    maximal = maximal_conversations(keep(prefix_hashes(numbered)))
    rows = numbered.join(maximal, _KEY, "left_semi").select(
        "conv_id", F.floor((F.col("k") - 1) / PART).alias("part"), "k", rendered(F.col("role"), F.col("text")).alias("turn"))
    return rows.groupBy("conv_id", "part").agg(
        F.count("*").alias("n_turns"), F.array_sort(F.collect_list(F.struct("k", "turn"))).alias("turns"),
    ).select("conv_id", "part", "n_turns", F.array_join(F.transform("turns", lambda x: x["turn"]), "").alias("text"))


OP9_SQL = r"""
with t as (
  select distinct conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations),
r as (
  select *, row_number() over (partition by conv_id order by turn nulls last, role, text) as k,
         count(*) over (partition by conv_id) as n from t),
p as (
  select conv_id, k, n, string_agg(role || chr(31) || text, chr(30)) over (partition by conv_id order by k) as prefix from r),
w as (select min(conv_id) as conv_id, prefix from p where k = n group by prefix),
m as (select conv_id from w where prefix not in (select prefix from p where k < n)),
c as (
  select conv_id, k, regexp_replace(role, '<\|(im_start|im_end)\|>', '< |\1| >', 'g') as role,
         regexp_replace(text, '<\|(im_start|im_end)\|>', '< |\1| >', 'g') as text from r join m using (conv_id))
select conv_id, (k - 1) // 256 as part, count(*) as n_turns,
       string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' order by k) as text
from c group by 1, 2
"""


@query("op9_chat_formatting", OP9_SQL)
def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(read_columns(spark, sf_dir, "conversations", conv_id="long", turn="long", role="string", text="string"))
