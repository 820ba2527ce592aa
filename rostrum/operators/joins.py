"""Joins beyond equality: best match per key, bands, nearest rows, fallbacks, and greedy one-to-one assignment."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostrum.functions.text import TAIL_HEAD, TITLE_HEAD, code_parts, normal_title, title_tail
from rostrum.session import materialize, partitions
from rostrum.sources.subtitles import duration_fits


def best_per_key(df: DataFrame, key: str, value: str, order: list[Column]) -> DataFrame:
    """key and the value of its first row by `order`, whose last column should make it total. One aggregate, no sort."""
    names = [f"_o{i}" for i in range(len(order))]
    rows = df.select(key, value, *(o.alias(n) for o, n in zip(order, names, strict=True)))
    return rows.groupBy(key).agg(F.min_by(value, F.struct(*names)).alias(value))


def band_join(left: DataFrame, right: DataFrame, keys: list[str], at_left: str, at_right: str, width: float) -> DataFrame:
    """Pairs with equal keys whose positions differ by at most `width`.

    Positions are cut into cells as wide as the band; a left row meets the right
    rows of its own and the two next cells, so a key with a third of all rows is
    spread over its cells. Rows with null keys or positions have no partner.
    """
    cell = F.floor(F.col(at_left) / width).try_cast("bigint")
    probes = left.filter(F.col(at_left).isNotNull()).withColumn("_cell", F.explode(F.array(cell - 1, cell, cell + 1)))
    cells = right.filter(F.col(at_right).isNotNull()).withColumn("_cell", F.floor(F.col(at_right) / width).try_cast("bigint"))
    return probes.join(cells, [*keys, "_cell"]).filter(F.abs(F.col(at_left) - F.col(at_right)) <= width).drop("_cell")


def nearest(left: DataFrame, right: DataFrame, keys: list[str], left_id: str, at_left: str, at_right: str, right_id: str, block: float = 600.0) -> DataFrame:
    """For each left row the right row of its keys nearest in position (of ties the smaller id): left_id, nearest_id, distance.

    Both sides are merged in order of position within blocks of positions; one
    summary row per block carries the last right row before it and the first after
    it. So a key with a third of all rows is spread over its blocks.
    """
    one = left.select(*keys, F.col(at_left).alias("at"), F.col(left_id).alias("lid"), F.lit(None).cast(right.schema[right_id].dataType).alias("rid"))
    # several right rows of one position: the smallest id stands for them
    two = right.filter(F.col(at_right).isNotNull()).groupBy(*keys, F.col(at_right).alias("at")).agg(F.min(right_id).alias("rid"))
    spots = two.withColumn("block", F.floor(F.col("at") / block).cast("bigint"))
    two = two.select(*keys, "at", F.lit(None).cast(left.schema[left_id].dataType).alias("lid"), "rid")
    both = one.filter("at is not null").unionByName(two).withColumn("block", F.floor(F.col("at") / block).cast("bigint"))
    spot = F.when(F.col("rid").isNotNull(), F.struct("at", "rid"))
    order = Window.partitionBy(*keys, "block").orderBy("at", F.col("rid").isNull())
    before = F.last(spot, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    after = F.first(spot, ignorenulls=True).over(order.rowsBetween(0, Window.unboundedFollowing))
    rows = both.select(*keys, "block", "at", "lid", before.alias("b"), after.alias("a")).filter("lid is not null")
    ends = spots.groupBy(*keys, "block").agg(F.min(F.struct("at", "rid")).alias("first"), F.max(F.struct("at", "rid")).alias("last"))
    # left rows' blocks take part, so that each finds what lies around it
    ends = ends.join(one.filter("at is not null").select(*keys, F.floor(F.col("at") / block).cast("bigint").alias("block")).distinct(), [*keys, "block"], "full")
    by_block = Window.partitionBy(*keys).orderBy("block")
    carried = ends.select(
        *keys, "block", F.last("last", ignorenulls=True).over(by_block.rowsBetween(Window.unboundedPreceding, -1)).alias("earlier"),
        F.first("first", ignorenulls=True).over(by_block.rowsBetween(1, Window.unboundedFollowing)).alias("later"),
    )
    rows = rows.join(carried, [*keys, "block"]).select("at", "lid", F.coalesce("b", "earlier").alias("b"), F.coalesce("a", "later").alias("a"))
    gap = lambda c: F.abs(F.col(f"{c}.at") - F.col("at"))
    best = F.array_min(F.array_compact(F.array(*(F.when(F.col(c).isNotNull(), F.struct(gap(c).alias("distance"), F.col(f"{c}.rid").alias("id"))) for c in "ba"))))
    return rows.select(F.col("lid").alias(left_id), best["id"].alias("nearest_id"), best["distance"].alias("distance")).filter("nearest_id is not null")


def reanchor(anchors: DataFrame, passages: DataFrame) -> DataFrame:
    """anchor_id, status ('live' or 'stale') and the seq at which an anchor's text is found now.

    Both have scope (item, kind, language), seq and sha; an anchor holds at its own
    seq if the text there is still the same, else at the only seq of its scope with
    that text, else nowhere.
    """
    scope = ["item_code", "kind", "language", "sha"]
    counted = passages.groupBy(*scope).agg(F.count("*").alias("places"), F.min("seq").alias("only_seq"))
    exact = passages.select(*scope, F.col("seq"), F.lit(True).alias("same")).distinct()
    rows = anchors.join(exact, [*scope, "seq"], "left").join(counted, scope, "left")
    found = F.when(F.col("same"), F.col("seq")).when(F.col("places") == 1, F.col("only_seq"))
    return rows.select("anchor_id", F.when(found.isNotNull(), "live").otherwise("stale").alias("status"), found.alias("live_seq"))


#: Parts of place names that a link's title may have alone.
PLACE_WORDS = "brockwood london saanen madras chennai bombay mumbai delhi bangalore rajghat rishi ojai berkeley malibu calcutta kolkata amsterdam ommen gstaad wimbledon".split()
#: Numbers of last letters by which a text is looked for in others; bits of the map of what is looked for.
ENDS, MAP_BITS = (16, 8, 4, 3, 2, 1, 0), 1 << 22
#: In place of the years of an item without any, and of the places of one without any.
ANY_YEAR, ANY_PLACE = 0, ""


def _item_years(year: Column, code: Column) -> Column:
    """The years of an item: its own, and those its code can mean (two digits of one year, four of two)."""
    digits = F.regexp_extract(code, r"^[A-Z]{2,3}(\d{2,4})", 1)
    two = lambda at: F.substring(digits, at, 2).try_cast("int")
    guessed = F.when(F.length(digits) == 2, F.array(F.when(two(1) > 30, 1900 + two(1)).otherwise(2000 + two(1)))).when(F.length(digits) == 4, F.array(1900 + two(1), 1900 + two(3)))
    years = F.concat(F.array(year.cast("int"), code_parts(code)["year"].cast("int")), F.coalesce(guessed, F.array().cast("array<int>")))
    return F.array_distinct(F.filter(years, lambda y: y.between(1900, 2035)))


def _link_years(title: Column) -> Column:
    """The years that a link's title names, also as 61/62."""
    whole = F.transform(F.regexp_extract_all(title, F.lit(r"\b((?:19|20)\d{2})\b"), 1), lambda y: y.cast("int"))
    pair = lambda i: F.transform(F.regexp_extract_all(title, F.lit(r"\b(\d{2})/(\d{2})\b"), i), lambda y: 1900 + y.cast("int"))
    return F.array_distinct(F.filter(F.concat(whole, pair(1), pair(2)), lambda y: y.between(1900, 2035)))


def _containing(texts: DataFrame, text: str, needles: DataFrame) -> DataFrame:
    """The rows of `texts` by each needle that the text contains, with the columns of `needles`; a row may come more than once.

    A needle is looked for by its last letters, as many of ENDS as it has, at every
    place of a text. What no needle ends in is dropped where it is made, by a map
    of hashes whose size is fixed. The join is never a broadcast: how far texts
    grow into runs of letters is not known to the planner.
    """
    needles = needles.filter("needle is not null").withColumn("end", F.right("needle", F.coalesce(*(F.when(F.length("needle") >= k, k) for k in ENDS))))
    sizes = [r[0] for r in needles.select(F.length("end")).distinct().collect()]  # no more than ENDS has
    bucket = F.pmod(F.hash("end"), F.lit(MAP_BITS))
    word, bit = F.shiftright(bucket, 6), bucket.bitwiseAND(63)
    set_bits = needles.select(word.cast("bigint").alias("word"), F.expr("1L").alias("one"), bit.alias("bit")).selectExpr("word", "shiftleft(one, bit) as bits")
    every = needles.sparkSession.range(MAP_BITS // 64).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    words = every.unionByName(set_bits).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    wanted = words.agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("words")).select(F.col("words.bits")).scalar()
    starts = F.when(F.col("size") == 0, F.array(F.lit(1))).when(F.length(text) >= F.col("size"), F.sequence(F.lit(1), F.length(text) - F.col("size") + 1))
    runs = texts.select("*", F.explode(F.array(*map(F.lit, sizes)).cast("array<int>")).alias("size")).select("*", F.explode(starts).alias("at"))
    runs = runs.withColumn("end", F.substring(text, F.col("at"), F.col("size"))).drop("size", "at")
    runs = runs.filter(F.getbit(F.element_at(wanted, word + 1), bit) == 1)
    return runs.join(needles.hint("merge"), "end").filter(F.contains(text, "needle")).drop("end")


def link_scores(items: DataFrame, links: DataFrame) -> DataFrame:
    """item_id, link_id, score of the pairs that belong together: 1.0 if the titles match (`titles_match`), 0.88 if the event's number is named.

    `items` has item_id, title, event_label, event_number and year, and may have
    code and place_name. An item of known years (its own and its code's) meets the
    links that name one of them, one without meets any link. A link whose title does
    not name the item's place is none of its; a title that is only a numbered
    question meeting matches none. Heads of titles, numbered events and places are
    looked for in all links' titles at once, and heads of links' tails in all items'
    titles; pairs are formed only where year, place and what was found agree. (A
    title's head in a link's tail is in the whole title too.)
    """
    optional = lambda c: (F.col(c) if c in items.columns else F.lit(None)).cast("string")
    or_any = lambda found, instead: F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(instead)))
    parts = partitions(items.sparkSession)

    place, title, phrase = optional("place_name"), normal_title("title"), normal_title(F.concat_ws(" ", "event_label", "event_number"))
    words = F.array(normal_title(F.substring_index(place, ",", 1)), *(F.when(F.contains(F.lower(place), F.lit(w)), F.lit(w)) for w in PLACE_WORDS))
    places = F.array_distinct(F.filter(words, lambda w: F.length(w) >= 4))
    generic = title.rlike(r"^\d+(?:st|nd|rd|th)\s+question\s+and\s+answer\s+meeting$")
    items = items.select("item_id", F.when((title != "") & ~generic, title).alias("title"), phrase.alias("phrase"), or_any(_item_years(F.col("year"), optional("code")), ANY_YEAR).alias("years"), or_any(places, ANY_PLACE).alias("places"))
    items = materialize(items.repartition(parts), "link-items")
    links = links.filter("link_title is not null").select("link_id", normal_title("link_title").alias("text"), F.left(title_tail("link_title"), F.lit(TAIL_HEAD)).alias("tail"), _link_years(F.col("link_title")).alias("years"))
    links = materialize(links.repartition(parts), "link-titles")

    way = F.struct((F.col("years")[0] != ANY_YEAR).alias("dated"), (F.col("places")[0] != ANY_PLACE).alias("placed"))
    heads = F.array(F.struct(F.left("title", F.lit(TITLE_HEAD)).alias("needle"), F.lit(1.0).alias("score")), F.struct(F.col("phrase").alias("needle"), F.lit(0.88).alias("score")))
    by_head = items.select("item_id", "years", "places", F.inline(F.filter(heads, lambda h: h["needle"] != ""))).withColumn("of_tail", F.lit(False))
    asked = by_head.select("needle", way.alias("way"), F.lit(False).alias("is_place"))
    asked = asked.unionByName(items.filter(F.col("places")[0] != ANY_PLACE).select(F.explode("places").alias("needle"), F.lit(None).cast("struct<dated: boolean, placed: boolean>").alias("way"), F.lit(True).alias("is_place")))
    needles = materialize(asked.groupBy("needle").agg(F.collect_set("way").alias("ways"), F.max("is_place").alias("is_place")), "link-needles")
    found = _containing(links, "text", needles)
    found = found.unionByName(links, allowMissingColumns=True).groupBy(*links.columns)
    sought = F.when(F.size("ways") > 0, F.struct("needle", "ways", F.lit(False).alias("of_tail")))
    found = found.agg(F.collect_set(F.when(F.col("is_place"), F.col("needle"))).alias("places"), F.collect_set(sought).alias("sought"))

    all_ways = F.array(*(F.struct(F.lit(d).alias("dated"), F.lit(p).alias("placed")) for d in (True, False) for p in (True, False)))
    tail = F.array(F.struct(F.col("tail").alias("needle"), all_ways.alias("ways"), F.lit(True).alias("of_tail")))
    named = found.select("link_id", "years", "places", F.inline(F.concat("sought", tail))).select("link_id", "years", "places", "needle", "of_tail", F.inline("ways"))
    named = named.withColumn("years", F.when(F.col("dated"), F.col("years")).otherwise(F.array(F.lit(ANY_YEAR)))).withColumn("places", F.when(F.col("placed"), F.col("places")).otherwise(F.array(F.lit(ANY_PLACE))))
    tails = materialize(links.select(F.col("tail").alias("needle")).distinct(), "link-tails")
    by_tail = _containing(items.filter("title is not null").select("item_id", "title", "years", "places"), "title", tails).select("item_id", "years", "places", "needle").distinct()
    wanted = by_head.unionByName(by_tail.select("*", F.lit(1.0).alias("score"), F.lit(True).alias("of_tail")))
    each = lambda rows, *columns: rows.select(*columns, "places", "needle", "of_tail", F.explode("years").alias("year")).select(*columns, "needle", "of_tail", "year", F.explode("places").alias("place"))
    pairs = each(wanted, "item_id", "score").join(each(named, "link_id").hint("merge"), ["needle", "of_tail", "year", "place"])
    return pairs.groupBy("item_id", "link_id").agg(F.max("score").alias("score"))


def greedy_assignment(scores: DataFrame, order: DataFrame, least: float = 0.85) -> DataFrame:
    """item_id, link_id, score: items in order each take their best unused link (of ties the smaller id).

    Who gets a link depends on all before, but only within a component of items and
    links that compete; each component is one group.
    """
    from rostrum.operators.graph import connected

    rows = scores.filter(F.col("score") >= least).join(order.select("item_id", "position"), "item_id")
    edges = rows.select(F.concat(F.lit("i"), F.col("item_id").cast("string")).alias("a"), F.concat(F.lit("l"), F.col("link_id").cast("string")).alias("b"))
    parts = connected(edges).withColumnRenamed("node", "_node")
    rows = rows.join(parts, F.concat(F.lit("i"), F.col("item_id").cast("string")) == F.col("_node")).drop("_node")

    def assign(frame: pd.DataFrame) -> pd.DataFrame:
        used, out = set(), []
        for _, mine in frame.sort_values(["position", "item_id", "score", "link_id"], ascending=[True, True, False, True]).groupby(["position", "item_id"], sort=True):
            for row in mine.itertuples():
                if row.link_id not in used:
                    used.add(row.link_id)
                    out.append((row.item_id, row.link_id, row.score))
                    break
        return pd.DataFrame(out, columns=["item_id", "link_id", "score"])

    return rows.groupBy("component").applyInPandas(assign, "item_id bigint, link_id bigint, score double")


def _claimants(claims: DataFrame) -> DataFrame:
    """code, path, drift of those claims of a shared path whose duration fits (null for the others), ranked by it (of ties the first code)."""
    fits = duration_fits(F.col("actual_secs"), F.col("expected_minutes"))
    drift = F.when(fits, F.abs(F.col("actual_secs") - F.col("expected_minutes") * 60.0))
    shared = Window.partitionBy("path")
    rows = claims.select("code", "path", drift.alias("drift"), F.count("*").over(shared).alias("claims")).filter("claims > 1")
    return rows.withColumn("place", F.row_number().over(shared.orderBy(F.col("drift").asc_nulls_last(), "code")))


def misattributed(claims: DataFrame) -> DataFrame:
    """Of several items that share a source file all but the one whose duration fits best: code, path, keeper.

    `claims` has code, path, actual_secs and expected_minutes; the keeper has the
    least difference of those that `duration_fits` (of ties the first code). Where
    none fits there is no keeper, and all items of the file come out.
    """
    best = F.first(F.when(F.col("drift").isNotNull(), F.col("code"))).over(Window.partitionBy("path").orderBy("place"))
    return _claimants(claims).withColumn("keeper", best).filter("keeper is null or place > 1").select("code", "path", "keeper")


def close_calls(claims: DataFrame) -> DataFrame:
    """path, keeper and runners_up (nearest first) where more than one item's duration fits, so that it cannot really decide."""
    fitting = _claimants(claims).filter("drift is not null").groupBy("path").agg(F.sort_array(F.collect_list(F.struct("place", "code")))["code"].alias("codes"))
    return fitting.filter(F.size("codes") > 1).select("path", F.col("codes")[0].alias("keeper"), F.slice("codes", F.lit(2), F.size("codes")).alias("runners_up"))
