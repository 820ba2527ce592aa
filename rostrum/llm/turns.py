"""Speech transcripts into clean, ordered speaker turns.

Everything is an SQL expression, a window or an aggregate. Noise is removed by
patterns. Labels at the head of a text or after a sentence cut it into pieces.
A label names a speaker if it is, or is one slip of the pen away from, a form of
the name; the forms come from the speakers table. Speakers are filled forward,
and turns are the islands of equal speakers.

No window runs over a whole transcript. Rows are cut into blocks of sequence
numbers; windows run within a block, and one summary row per block carries the
speaker and the open turn on to the next. A transcript with a third of all rows
is spread over its blocks.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostrum.session import lookup_rows, materialize

#: Sequence numbers of a block.
BLOCK = 512
#: Shortest form of a name that may be misspelt.
FUZZY_LENGTH = 5

# Titles and ordinals before a name.
TITLES = ["mr", "mrs", "ms", "miss", "dr", "prof", "professor", "sister", "brother", "sir", "madam"]
ORDINALS = ["the", "first", "second", "third", "fourth", "fifth", "another", "next", "last"]

_CUT, _MID, _END = "\u0001", "\u0002", "\u0003"

#: What is never speech: sound annotations and time stamps. Brackets that may hold a speaker's label stay.
NOISE = r"(?=[(<{*♪\[\d-])(?:%s)" % "|".join(
    [
        r"\(\([^()]*\)\)", r"<[^<>]*>", r"\{[^{}]*\}", r"\*[^*]{1,60}\*", r"--\s*[^-]{1,60}--", "♪[^♪]*♪",
        r"[\[(][^\[\]()]*\d:\d\d[^\[\]()]*[\])]", r"(?<!\d)(?<!\d:)\d{1,2}:\d\d(?::\d\d)?(?:[.,]\d+)?(?![\d:])",
    ]
)
HESITATION = r"(?i)(?=[uemha])(?<![\p{L}\p{N}'’-])(?:u+h+m*|u+m+|e+r+m*|m{2,}|h+m+|a+h+|e+h+)(?![\p{L}\p{N}'’-])(?:\.{2,}|…)?,?"
FILLER = r"(?i)(?=[yski])(?<!\p{L})(?:you know|sort of|kind of|i mean),"
BRACKETED = r"\[[^\[\]]*\]|\([^()]*\)"

_TOKEN = r"(?:(?<!\p{L})\p{L}\.|(?i:mrs?|ms|dr|prof)\.|[\p{L}\p{N}][\p{L}\p{N}'’-]*)"
_ASIDE = r"(?:\s*\((?i:cont'?d\.?|continued|from [^()]{1,24})\))*"
_NAME = rf"{_TOKEN}(?:\s*{_TOKEN}){{0,4}}?{_ASIDE}"
#: A label's place: the head, or after the end of a sentence or a bracket.
LABEL = rf"(^\s*|[.?!…)\]]['\"”’]*\s+|(?=>>))(?:>>\s*|-\s+)?(?:(?=[^:\[(]{{1,48}}[:(])({_NAME})\s*:|(?=[\[(])([\[(]\s*{_NAME}\s*[\])]):?)"


def label_forms(speakers: DataFrame, code: str = "speaker_code", name: str = "display_name", others: str = "other_names", unknown: str = "UNK") -> list[tuple[str, str]]:
    """(form, code) for every way in which a speaker's name may be written; forms that two speakers share are left out."""
    found: dict[str, set[str]] = {}

    def add(form: str, to: str) -> None:
        if form := normal_form(form):
            found.setdefault(form, set()).add(to)

    for row in lookup_rows(speakers.select(code, name, others).distinct()):
        who = (row[0] or "").strip()
        if not who or who == unknown:
            continue
        add(who, who)
        add(" ".join(who), who)
        for full in [row[1], *(row[2] or "").split(";")]:
            words = [w for w in (full or "").split() if w]
            if not words:
                continue
            add(" ".join(words), who)
            if len(words) == 1:
                continue
            last, bare = words[-1], [w for w in words if not re.fullmatch(r"\w\.?", w)]
            add(" ".join(bare), who)
            given = [w for w in bare[:-1] if w.lower().strip(".") not in TITLES]
            for x in [last, *(f"{title} {last}" for title in TITLES), *(f"{w[0]} {last}" for w in given), *(f"{w} {last}" for w in bare[:-1])]:
                add(x, who)
            add(" ".join(w[0] for w in words), who)
    return sorted((form, *who) for form, who in found.items() if len(who) == 1)


def normal_form(label: str) -> str:
    return re.sub(r"\s+", " ", label.lower().replace(".", " ")).strip()


def _normal_label(label: Column) -> Column:
    """A label without marks, asides, numbers and ordinals, in the spelling of label_forms."""
    x = F.regexp_replace(label, r"^[\s>\[(-]+", "")
    x = F.regexp_replace(x, r"\([^()]*\)", " ")
    x = F.regexp_replace(x, r"[\s:;\])]+$", "")
    x = F.trim(F.regexp_replace(F.lower(x), r"[.\s]+", " "))
    x = F.regexp_replace(x, rf"^(?:{'|'.join(ORDINALS)}) +(?=.)", "")
    return F.trim(F.regexp_replace(x, r"(?<=\p{L}) *\d+$", ""))


def _speakers_of(labels: DataFrame, forms: list[tuple[str, str]]) -> DataFrame:
    """normal, who: the code that each normal label stands for: exactly, or with one letter wrong, missing, extra or swapped (the first code of several)."""
    table = labels.sparkSession.createDataFrame([(f, c, len(f)) for f, c in forms], "form string, code string, length int")
    exact = labels.join(table, F.col("normal") == F.col("form")).select("normal", F.lit(0).alias("d"), "code")
    size = F.length("normal")
    near = labels.filter(size >= FUZZY_LENGTH - 1).select("normal", F.explode(F.array(size - 1, size, size + 1)).alias("length"))
    letters = lambda c: F.array_sort(F.split(c, ""))
    d = F.levenshtein("form", "normal", 2)
    pairs = near.join(table.filter(F.col("length") >= FUZZY_LENGTH), "length").withColumn("d", d).filter("d >= 0")
    swapped = (F.col("d") == 2) & (F.length("form") == size) & (letters("form") == letters("normal"))
    pairs = pairs.select("normal", F.when(swapped, 1).otherwise(F.col("d")).alias("d"), "code").filter("d <= 1")
    return exact.unionByName(pairs).groupBy("normal").agg(F.min(F.struct("d", "code"))["code"].alias("who"))


def _clean(text: Column) -> Column:
    noisy = text.rlike(r"[<{*\[(♪]|\d:\d|--")
    return F.regexp_replace(F.when(noisy, F.regexp_replace(text, NOISE, " ")).otherwise(text), HESITATION, " ")


def _cut_texts(segments: DataFrame, with_text: bool) -> DataFrame:
    """Pieces of the texts without noise, each with the label written at its head, the first also with the row's raw_label."""
    # copies of a row differ in nothing that is read here
    rows = segments.select("id", "transcript_id", "seq", "raw_label", "speaker_code", "attribution", "text")
    rows = rows.filter("transcript_id is not null and seq is not null and text is not null")
    cleaned = _clean(F.col("text"))
    without_filler = F.trim(F.regexp_replace(cleaned, FILLER, " "))
    rows = rows.withColumn("plainer", without_filler)
    marked = F.when(F.col("plainer").rlike(r"[:\[(]"), F.regexp_replace("plainer", LABEL, f"$1{_CUT}$2{_MID}$3{_END}")).otherwise(F.col("plainer"))
    rows = rows.withColumn("marked", marked).select("id", "transcript_id", "seq", "raw_label", "speaker_code", "attribution", F.posexplode(F.split("marked", _CUT)).alias("piece", "part"))
    has_label = F.col("part").contains(_MID)
    plain = F.when(has_label, F.substring_index("part", _MID, 1))
    bracket = F.when(has_label, F.substring_index(F.substring_index("part", _END, 1), _MID, -1))
    rest = F.when(has_label, F.substring_index("part", _END, -1)).otherwise(F.col("part"))
    rows = rows.select("*", F.nullif(plain, F.lit("")).alias("plain"), bracket.alias("bracket"), rest.alias("rest"))
    raw = F.when(F.col("piece") == 0, F.col("raw_label"))
    text = ["plain", "rest"] if with_text else [F.col("plain").isNotNull().alias("has_plain"), _spoken(F.col("rest")).alias("rest_speaks")]
    return rows.select("id", "transcript_id", "seq", "piece", F.upper(F.trim("speaker_code")).alias("code"), "attribution", F.coalesce("plain", "bracket").alias("written_label"), raw.alias("raw_label"), *text)


def _bare(said: Column) -> Column:
    """What is said, without brackets that name nobody."""
    return F.when(said.rlike(r"[\[(]"), F.regexp_replace(said, BRACKETED, " ")).otherwise(said)


def _spoken(said: Column) -> Column:
    return _bare(said).rlike(r"[\p{L}\p{N}]")


def speech_pieces(segments: DataFrame, speakers: DataFrame, with_text: bool = True) -> DataFrame:
    """Pieces of speech in order, each with the speaker it names (`written`, `raw`) if it names one, and with what is said only if asked.

    Reads transcript_id, id, seq, raw_label, speaker_code, attribution and text.
    The texts are cut once and written to the shared folder. Their distinct labels
    are resolved once each; those that name a speaker, which are few, are joined
    back.
    """
    forms = label_forms(speakers)
    rows = materialize(_cut_texts(segments, with_text), "pieces")
    labels = rows.select(F.col("written_label").alias("label")).unionAll(rows.select(F.col("raw_label").alias("label"))).filter("label is not null").distinct()
    labels = materialize(labels.withColumn("normal", _normal_label(F.col("label"))).filter("normal <> ''"), "labels")
    named = materialize(labels.join(_speakers_of(labels.select("normal").distinct(), forms), "normal").select("label", "who"), "named-labels")
    for label, who in (("written_label", "written"), ("raw_label", "raw")):
        rows = rows.join(named.select(F.col("label").alias(label), F.col("who").alias(who)), label, "left")
    known = sorted({c for _, c in forms})
    code = F.when(F.col("code").isin(known), F.col("code")) if known else F.lit(None).cast("string")
    # a colon after words that name nobody is part of the speech; a bracket that names nobody is a sound
    nobody = F.col("written").isNull()
    if with_text:
        said = F.when(nobody & F.col("plain").isNotNull(), F.concat("plain", F.lit(":"), "rest")).otherwise(F.col("rest"))
        text = [F.trim(F.regexp_replace(_bare(said), r"\s+", " ")).alias("said"), _spoken(said).alias("speech")]
    else:
        text = [(F.col("rest_speaks") | (nobody & F.col("has_plain"))).alias("speech")]
    return rows.select("id", "transcript_id", "seq", "piece", "written", "raw", code.alias("code"), "attribution", *text)


def named_pieces(pieces: DataFrame) -> DataFrame:
    """One row per segment and piece that holds speech: what it names itself, else null to go on with the speaker before.

    Pieces of one row whose labels name nobody belong to the piece before them.
    """
    keys = ["transcript_id", "seq", "id"]
    own = Window.partitionBy(*keys).orderBy("piece").rowsBetween(Window.unboundedPreceding, 0)
    label = F.when(F.col("piece") == 0, F.coalesce("written", "raw")).otherwise(F.col("written"))
    # the first label of a row: raw_label holds until a label in the text
    rows = pieces.withColumn("label", F.last(label, ignorenulls=True).over(own)).filter("speech")
    goes_on = F.col("attribution").isNull() | (F.lower(F.trim("attribution")) == "inherit")
    named = F.when(F.col("label").isNotNull(), F.col("label")).when(~goes_on, F.col("code"))
    said = ["said"] if "said" in pieces.columns else []
    return rows.select(*keys, "piece", named.alias("named"), "code", *said).dropDuplicates([*keys, "piece"])


def speaker_turns(segments: DataFrame, speakers: DataFrame, with_text: bool = True, block: int = BLOCK, unknown: str = "UNK") -> DataFrame:
    """transcript_id, turn, first_seq, last_seq, speaker_code and the text of every turn.

    Defined cases: rows with a null transcript, seq or text, and rows in which
    nothing but noise is left, take no part. Copies of a row count once. Rows of
    one seq follow each other by id. A turn whose speaker can't be known, at the
    start of a transcript or where speaker_code must hold and names nobody, goes
    on with the speaker before it, and without one is UNK. Empty tables give
    empty results; without speakers every turn is UNK. Other columns are ignored.
    """
    rows = named_pieces(speech_pieces(segments, speakers, with_text)).withColumn("block", F.floor(F.col("seq") / block).cast("bigint"))
    rows = materialize(rows, "named-pieces")  # read twice: for the blocks' ends and for the rows
    at = F.struct("seq", "id", "piece")
    in_block = Window.partitionBy("transcript_id", "block").orderBy("seq", "id", "piece")
    so_far = in_block.rowsBetween(Window.unboundedPreceding, 0)
    ends = rows.groupBy("transcript_id", "block").agg(
        F.max_by("named", F.when(F.col("named").isNotNull(), at)).alias("last_named"), F.min_by("code", at).alias("first_code"),
    )
    by_block = Window.partitionBy("transcript_id").orderBy("block")
    before = by_block.rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        "transcript_id", "block", F.last("last_named", ignorenulls=True).over(before).alias("carried"),
        F.first("first_code").over(by_block.rowsBetween(Window.unboundedPreceding, 0)).alias("opening"),
    )
    rows = rows.withColumn("own", F.last("named", ignorenulls=True).over(so_far)).join(carried, ["transcript_id", "block"])
    rows = rows.withColumn("speaker_code", F.coalesce("own", "carried", "opening", F.lit(unknown)))
    changed = F.coalesce((F.col("speaker_code") != F.lag("speaker_code").over(in_block)).cast("int"), F.lit(0))
    rows = rows.withColumn("changed", changed).withColumn("island", F.sum("changed").over(so_far))
    text = [F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "id", "piece", "said"))), lambda x: x["said"]), " ").alias("text")] if with_text else []
    islands = rows.groupBy("transcript_id", "block", "island").agg(
        F.first("speaker_code").alias("speaker_code"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"), *text,
    )
    islands = materialize(islands, "islands")  # read twice: for the blocks' turns at both ends and for the rows
    blocks = islands.groupBy("transcript_id", "block").agg(
        F.max("island").alias("last_island"), F.min_by("speaker_code", "island").alias("head"), F.max_by("speaker_code", "island").alias("tail"),
    )
    blocks = blocks.withColumn("goes_on", F.coalesce(F.col("head") == F.lag("tail").over(by_block), F.lit(False)))
    open_turn = F.when((F.col("last_island") > 0) | ~F.col("goes_on"), F.struct("block", F.col("last_island").alias("island")))
    blocks = blocks.select("transcript_id", "block", "goes_on", F.last(open_turn, ignorenulls=True).over(before).alias("open_turn"))
    islands = islands.join(blocks, ["transcript_id", "block"])
    joins = F.col("goes_on") & (F.col("island") == 0)
    islands = islands.withColumn("turn_key", F.when(joins, F.col("open_turn")).otherwise(F.struct("block", "island")))
    whole = [F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "text"))), lambda x: x["text"]), " ").alias("text")] if with_text else []
    return islands.groupBy("transcript_id", "turn_key").agg(
        F.min("first_seq").alias("first_seq"), F.max("last_seq").alias("last_seq"), F.first("speaker_code").alias("speaker_code"), *whole,
    ).drop("turn_key")
