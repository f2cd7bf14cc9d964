"""Entity names beyond what one call holds: overlapping calls over names that may be one, and their replies merged.

Two names meet in a call if a word of one begins with the same three letters as a word of the other; titles, articles and the
like don't count where a name has other words.  Blocks of such names lie side by side in calls of a bounded number of names.
A block of too many names is cut into parts, and each pair of parts meets in a call of its own, so however common a beginning
is, no pair is left out.  Within a call the last line that names a variant wins, as in a single one; names that calls link are
one component, whose canonical name is that which no call replaces, of several the one written last.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgraph.functions.vocabulary import FILTER_WORDS, SUFFIXES, TITLES
from textgraph.operators import sections as S

Keep = Callable[[DataFrame, str], DataFrame]
#: Letters of a word's beginning.
BEGINNING = 3


def beginnings(name: Column) -> Column:
    """The beginnings of a name's words that tell something; of all of them where none does."""
    words = F.filter(F.split(F.lower(name), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    telling = F.filter(words, lambda w: ~w.isin(*FILTER_WORDS) & ~w.rlike(f"(?i)^(?:{TITLES}|{SUFFIXES})$") & (F.length(w) > 1))
    own = F.when(F.size(telling) > 0, telling).when(F.size(words) > 0, words).otherwise(F.array(name))
    return F.array_distinct(F.transform(own, lambda w: F.left(w, F.lit(BEGINNING))))


def calls(names: DataFrame, most: int, keep: Keep) -> DataFrame:
    """(call, entity): names that may be one share a call, of no more than ``most`` names (4 at least)."""
    room = max(2, most // 2)  # of a block, so that two parts of a cut one, and what shares a call with it, have room
    half = max(1, room // 2)
    each = keep(names.select("entity", F.explode(beginnings(F.col("entity"))).alias("beginning")), "beginnings")
    sizes = each.groupBy("beginning").agg(F.count("*").alias("n")).where("n > 1")
    met = each.join(sizes.withColumn("parts", F.when(F.col("n") > room, F.ceil(F.col("n") / half)).otherwise(0).cast("int")), "beginning")
    part = F.pmod(F.xxhash64("entity"), F.col("parts")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.greatest(F.col("parts") - 1, F.lit(0))), lambda o: F.struct(F.least(part, o).alias("i"), F.greatest(part, o).alias("j")))
    single = F.array(F.struct(F.lit(-1).alias("i"), F.lit(-1).alias("j")))
    blocks = met.select("entity", "beginning", F.explode(F.when(F.col("parts") > 0, others).otherwise(single)).alias("p"))
    block = F.when(F.col("p.i") < 0, F.col("beginning")).otherwise(F.concat_ws("/", "beginning", F.lpad(F.col("p.i").cast("string"), 9, "0"), F.lpad(F.col("p.j").cast("string"), 9, "0")))
    blocks = keep(blocks.select("entity", block.alias("block")), "blocks")
    totals = keep(blocks.groupBy("block").agg(F.count("*").alias("n")), "totals")
    # a call takes the blocks that begin within its room, side by side
    at = S.before(totals, "block", "block", S.bounds(totals, "block")).select("block", F.floor(F.col("before") / room).alias("call"))
    return blocks.join(at, "block").select("call", "entity").distinct()


def merged(replies: DataFrame, keep: Keep) -> DataFrame:
    """(variant, canonical) over the replies of several calls, (call, g, k, variant, canonical) a line."""
    last = F.max_by(F.struct("canonical", "g", "k"), F.struct("g", "k")).alias("x")
    own = keep(replies.groupBy("call", "variant").agg(last).select("call", "variant", "x.*"), "lines")
    links = own.where("variant <> canonical").select(F.col("variant").alias("a"), F.col("canonical").alias("b")).distinct()
    found = connected(links, keep)
    replaced = links.select(F.col("a").alias("canonical")).distinct().withColumn("replaced", F.lit(True))
    written = own.groupBy("canonical").agg(F.max(F.struct("call", "g", "k")).alias("at")).join(replaced, "canonical", "left")
    chosen = written.join(found.withColumnRenamed("name", "canonical"), "canonical").groupBy("component").agg(F.max_by("canonical", F.struct(F.col("replaced").isNull(), "at")).alias("canonical"))
    several = found.join(chosen, "component").select(F.col("name").alias("variant"), "canonical")
    alone = own.where("variant = canonical").select("variant", "canonical").distinct().join(found.select(F.col("name").alias("variant")), "variant", "left_anti")
    return keep(several.union(alone), "mapping")


def connected(links: DataFrame, keep: Keep) -> DataFrame:
    """(name, component): names that links (a, b) join; each round takes the smallest label around, and that label's label."""
    both = keep(links.union(links.select("b", "a")).distinct(), "links")
    labels = keep(both.groupBy(F.col("a").alias("name")).agg(F.least(F.min("b"), F.col("name")).alias("component")), "labels0")
    number = 0
    while True:
        around = both.join(labels.select(F.col("name").alias("b"), "component"), "b").groupBy(F.col("a").alias("name")).agg(F.min("component").alias("around"))
        least = labels.join(around, "name").select("name", "component", F.least("component", "around").alias("least"))
        jump = labels.select(F.col("name").alias("least"), F.col("component").alias("further"))
        after = least.join(jump, "least", "left").select("name", F.least("least", F.coalesce("further", "least")).alias("component"), F.col("component").alias("was"))
        after = keep(after, f"labels{number + 1}")
        if not after.where("component <> was").limit(1).count():
            return after.drop("was")
        labels, number = after.drop("was"), number + 1
