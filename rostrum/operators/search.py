"""Full-text retrieval: prefix terms, postings, a kept index, BM25, and the capped list without repeated texts.

Scores are those of an SQLite full-text table over the same rows: k1 = 1.2 and
b = 0.75, an inverse document frequency of ln((N - n + 0.5) / (n + 0.5)) with a
floor of 1e-6, and lower scores better.

Two ways lead to a score. `bm25` reads the texts once, for a query over rows that
are not indexed. An `Index` is kept: its postings lie in buckets by the first
letters of the term, so that a query reads the buckets of its terms only, and
rows are added to and removed from it.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostrum.functions.text import folded, normal_space, tokens
from rostrum.session import materialize

# The constants of the score, and words that carry no meaning of their own in a name.
K1, B, FLOOR = 1.2, 0.75, 1e-6
STOPWORDS = ["and", "are", "from", "its", "not", "only", "the", "what", "will", "without", "you"]
LEAST_TERM = 3
#: Buckets of an index's terms.
BUCKETS = 64
#: A letter or digit and what goes on with it; marks that are folded away part no token.
_TOKEN = r"[\p{L}\p{N}][\p{L}\p{N}\u0300-\u036f]*"


def query_terms(name: str, aliases: list[str] = (), extra: list[str] = ()) -> list[str]:
    """The words of a concept's forms in order, each once, of three letters or more. Words without meaning of their own only where one is a whole form.

    Words are those of the index: an apostrophe or a low line parts them.
    """
    forms = [re.findall(r"[^\W_]+", form.lower()) for form in (name, *aliases, *extra)]
    kept = {words[0] for words in forms if len(words) == 1}
    meant = (w for words in forms for w in words if w in kept or w not in STOPWORDS)
    return list(dict.fromkeys(w for w in meant if len(w) >= LEAST_TERM))


def registry_terms(forms: DataFrame, key: str, position: str, form: str) -> DataFrame:
    """key, place, term: `query_terms` of every concept of a registry, whose forms are rows in order of position."""
    words = F.regexp_extract_all(F.lower(form), F.lit(r"[\p{L}\p{N}]+"), 0)
    rows = forms.select(key, position, words.alias("_words")).filter(F.size("_words") > 0)
    alone = rows.filter(F.size("_words") == 1).select(key, F.col("_words")[0].alias("term")).distinct().withColumn("_alone", F.lit(True))
    rows = rows.select(key, position, F.posexplode("_words").alias("_i", "term")).filter(F.length("term") >= LEAST_TERM)
    first = rows.groupBy(key, "term").agg(F.min(F.struct(position, "_i")).alias("_at")).join(alone, [key, "term"], "left")
    first = first.filter(F.col("_alone") | ~F.col("term").isin(STOPWORDS))
    return first.select(key, F.row_number().over(Window.partitionBy(key).orderBy("_at")).alias("place"), "term")


def fold_term(term: str) -> str:
    """A term as the texts' tokens are folded."""
    return "".join(c for c in unicodedata.normalize("NFD", term.lower()) if not unicodedata.combining(c))


def postings(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """term, id, tf, doc_len: the inverted index as a table. Terms are counted within each row."""
    rows = docs.select(F.col(id_col).alias("id"), F.array_sort(tokens(text_col)).alias("toks"))
    rows = rows.withColumn("starts", F.array_compact(F.transform("toks", lambda x, i: F.when((i == 0) | (F.get("toks", i - 1) != x), i))))
    counts = F.transform("starts", lambda at, j: F.struct(F.get("toks", at).alias("term"), (F.coalesce(F.get("starts", j + 1), F.size("toks")) - at).cast("bigint").alias("tf")))
    return rows.select("id", F.size("toks").cast("bigint").alias("doc_len"), F.explode(counts).alias("x")).select("x.term", "id", "x.tf", "doc_len")


def prefix_counts(docs: DataFrame, text_col: str, prefixes: list[str], of_hits: dict[str, Column] | None = None) -> DataFrame:
    """The rows without their text, with doc_len and f0, f1, ...: the number of tokens with each prefix. One pass, without a shuffle.

    Tokens are made only of texts in which one pattern finds a prefix; `of_hits` are
    further columns, worked out for these texts only.
    """
    hit = folded(text_col).rlike(rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(map(re.escape, prefixes))})")
    rows = docs.withColumns({"_hit": hit, "doc_len": F.coalesce(F.regexp_count(text_col, F.lit(_TOKEN)), F.lit(0))})
    rows = rows.withColumn("_toks", F.when(F.col("_hit"), tokens(text_col)))
    starting = lambda p: F.size(F.filter("_toks", lambda t: t.startswith(p)))
    counts = [F.when(F.col("_hit"), starting(p)).otherwise(0).alias(f"f{i}") for i, p in enumerate(prefixes)]
    more = [F.when(F.col("_hit"), c).alias(name) for name, c in (of_hits or {}).items()]
    return rows.select(*(c for c in docs.columns if c != text_col), "doc_len", *counts, *more)


def _scored(counted: DataFrame, names: list[str], total: int, mean: float, found: list[int]) -> DataFrame:
    """The rows with any of the counts, with `score`."""
    mean = mean or 1.0

    def part(f: str, n: int) -> Column:
        idf = F.ln((F.lit(float(total)) - n + 0.5) / (F.lit(float(n)) + 0.5))
        idf = F.when(idf > 0, idf).otherwise(F.lit(FLOOR))
        tf = F.col(f).cast("double")
        return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * F.col("doc_len") / mean))

    score = -reduce(lambda a, b: a + b, [part(f, n) for f, n in zip(names, found, strict=True)])
    return counted.filter(reduce(lambda a, b: a | b, [F.col(f) > 0 for f in names])).withColumn("score", score).drop(*names)


def bm25(docs: DataFrame, text_col: str, prefixes: list[str], of_hits: dict[str, Column] | None = None) -> DataFrame:
    """The rows that have a token with one of the prefixes, without their text, with `doc_len` and `score`. Statistics are over all rows.

    One pass reads the texts and writes their counts, a few numbers a row; these
    give the statistics and the scores. No rows are shuffled. Null and empty texts
    count as rows of length 0. No prefix, no rows.
    """
    prefixes = list(dict.fromkeys(fold_term(p) for p in prefixes))
    if not prefixes:
        more = {name: F.lit(None).cast("string") for name in of_hits or {}}
        return docs.drop(text_col).limit(0).withColumns({"doc_len": F.lit(0), **more, "score": F.lit(0.0)})
    counted = materialize(prefix_counts(docs, text_col, prefixes, of_hits), "prefix-counts")
    names = [f"f{i}" for i in range(len(prefixes))]
    stats = counted.agg(F.count("*").alias("rows"), F.avg("doc_len").alias("mean"), *(F.count_if(F.col(f) > 0).alias(f) for f in names)).first()
    return _scored(counted, names, stats["rows"], float(stats["mean"] or 0.0), [stats[f] for f in names])


# -- a kept index ----------------------------------------------------------------------


def _bucket(term: str) -> int:
    return zlib.crc32(term[:LEAST_TERM].encode()) % BUCKETS


@dataclass(frozen=True)
class Index:
    """`postings`: term, id, tf, doc_len and the bucket of the term's first letters; `rows`: id, doc_len of every indexed row, also of empty ones."""

    postings: DataFrame
    rows: DataFrame

    @classmethod
    def of(cls, docs: DataFrame, id_col: str, text_col: str) -> Index:
        """The index of rows with unique ids; a null text is an empty one."""
        found = postings(docs, id_col, text_col)
        bucket = F.pmod(F.crc32(F.substring("term", 1, LEAST_TERM)), F.lit(BUCKETS)).cast("int")
        return cls(found.withColumn("bucket", bucket), docs.select(F.col(id_col).alias("id"), F.coalesce(F.regexp_count(text_col, F.lit(_TOKEN)), F.lit(0)).cast("bigint").alias("doc_len")))

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Index:
        return cls(spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/rows"))

    def write(self, path: str) -> Index:
        """Writes the index, which must not be read from the same path, and reads it back; the buckets are folders, so that a query opens those of its terms only."""
        spark = self.rows.sparkSession
        self.postings.repartition("bucket", F.pmod(F.xxhash64("id"), F.lit(8))).write.partitionBy("bucket").parquet(f"{path}/postings")
        self.rows.write.parquet(f"{path}/rows")
        return Index.read(spark, path)

    def add(self, other: Index) -> Index:
        """With another's rows, which replace those of the same id."""
        kept = self.remove(other.rows.select("id"))
        return Index(kept.postings.unionByName(other.postings), kept.rows.unionByName(other.rows))

    def remove(self, ids: DataFrame) -> Index:
        """Without the rows of these ids (a column id)."""
        gone = ids.select("id").distinct()
        return Index(self.postings.join(gone, "id", "left_anti"), self.rows.join(gone, "id", "left_anti"))

    def size(self) -> tuple[int, int]:
        """Indexed rows and postings."""
        return self.rows.count(), self.postings.count()

    def search(self, prefixes: list[str]) -> DataFrame:
        """id, doc_len, score of the rows that have a term with one of the prefixes."""
        prefixes = list(dict.fromkeys(fold_term(p) for p in prefixes))
        names = [f"f{i}" for i in range(len(prefixes))]
        stats = self.rows.agg(F.count("*").alias("rows"), F.avg("doc_len").alias("mean")).first()
        read = self.postings
        if all(len(p) >= LEAST_TERM for p in prefixes):
            read = read.filter(F.col("bucket").isin(sorted({_bucket(p) for p in prefixes})))
        fits = [F.startswith("term", F.lit(p)) for p in prefixes]
        read = read.filter(reduce(lambda a, b: a | b, fits, F.lit(False)))
        counts = [F.sum(F.when(fit, F.col("tf")).otherwise(0)).alias(f) for f, fit in zip(names, fits, strict=True)]
        counted = materialize(read.groupBy("id").agg(F.max("doc_len").alias("doc_len"), *counts), "index-counts")
        if not prefixes:
            return counted.withColumn("score", F.lit(0.0))
        found = counted.agg(*(F.count_if(F.col(f) > 0).alias(f) for f in names)).first()
        return _scored(counted, names, stats["rows"], float(stats["mean"] or 0.0), [found[f] for f in names])


def purge(index: Index, ids: DataFrame) -> tuple[Index, dict[str, int]]:
    """The index without these rows, and the counts before, removed and after; an error if they don't add up or a purged row is left."""
    gone = materialize(ids.select("id").distinct(), "purged")
    left = index.remove(gone)
    counts = {"before": index.rows.count(), "removed": index.rows.join(gone, "id", "left_semi").count(), "after": left.rows.count(), "left_over": left.postings.join(gone, "id", "left_semi").count()}
    if counts["before"] - counts["removed"] != counts["after"] or counts["left_over"]:
        raise ValueError(f"purge of an index: {counts}")
    return left, counts


# -- lists -----------------------------------------------------------------------------


def text_key(text: Column | str) -> Column:
    """The same for texts that differ in blanks only."""
    return F.sha2(normal_space(F.coalesce(text, F.lit(""))), 256)


def capped_distinct(ranked: DataFrame, order: list, group_col: str, key_col: str, per_group: int, limit: int) -> DataFrame:
    """The best rows in order with their `rank`, at most `per_group` of a group, none whose key (see text_key) was taken before.

    Whether a row is taken depends on those taken before it, so the last step is one
    pass on the driver, over few rows whatever the table's size. Let g = limit /
    per_group be the groups that can fill up before the list does. Of a group and
    key only the best row can be taken. Of a key only the best g + 1 (a further one
    would mean that g groups are full), of a group only the best per_group + limit
    (rows whose key was taken before are at most `limit`). Of what remains, at most
    limit x (g + 1) rows are refused for their key and g x (per_group + limit) for
    their group, so the best of that number and `limit` more hold the list. The
    windows cut each task's rows before they are shuffled (row_number with a bound).
    """
    full = max(1, limit // per_group)
    rows = ranked
    for keys, most in (([group_col, key_col], 1), ([key_col], full + 1), ([group_col], per_group + limit)):
        rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_n") <= most).drop("_n")
    head = rows.orderBy(*order).limit(limit * (full + 1) + full * (per_group + limit) + limit).collect()
    taken, counts, texts = [], {}, set()
    for row in head:
        group = row[group_col]
        if counts.get(group, 0) < per_group and row[key_col] not in texts:
            texts.add(row[key_col])
            counts[group] = counts.get(group, 0) + 1
            taken.append(row)
        if len(taken) == limit:
            break
    schema = T.StructType([T.StructField("rank", T.IntegerType()), *ranked.schema.fields])
    return ranked.sparkSession.createDataFrame([(i + 1, *row) for i, row in enumerate(taken)], schema)


def recall_report(gold: DataFrame, capped: DataFrame, uncapped: DataFrame, matches: DataFrame, keys: list[str], least_words: int) -> DataFrame:
    """Each gold citation with its rank, or why it was missed: min_words, per_item, rank or vocabulary, the first that holds.

    `gold` has the keys and word_count, `capped` the keys and rank of the list,
    `uncapped` the keys of the list without a cap per group, and `matches` the keys
    of all rows that have a term at all.
    """
    found = capped.groupBy(*keys).agg(F.min("rank").alias("found_rank"))
    mark = lambda df, name: df.select(*keys).distinct().withColumn(name, F.lit(True))
    rows = gold.join(found, keys, "left").join(mark(uncapped, "_free"), keys, "left").join(mark(matches, "_match"), keys, "left")
    reason = F.when(F.col("found_rank").isNotNull(), "found").when(F.col("word_count") < least_words, "min_words").when(F.col("_free"), "per_item").when(F.col("_match"), "rank").otherwise("vocabulary")
    return rows.select(*gold.columns, "found_rank", reason.alias("outcome"))
