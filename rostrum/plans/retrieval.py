"""Full-text queries over documents and segments."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.functions.text import timecode, timed_url, tokens, word_count
from rostrum.operators.joins import best_per_key
from rostrum.operators.search import STOPWORDS, Index, bm25, capped_distinct, postings, purge, query_terms, recall_report, registry_terms, text_key
from rostrum.session import materialize, r6, shared_dir, spread, table

#: A concept's forms, as a registry would hold them.
CONCEPT, ALIASES = "Silence & Listening", ["quiet mind", "attention"]
TERMS = query_terms(CONCEPT, ALIASES)
LIMIT, PER_SOURCE, LEAST_WORDS = 60, 10, 60
#: Of the search view: hits of an item, and their least words.
PER_ITEM, LEAST_HIT_WORDS = 2, 20
LINK_BASE = "https://media.example/"
CITED_KINDS = ["letter", "study_note", "dialogue"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents", "doc_id", "text", "source", "item_code"))


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every matching document with its score and, instead of its text, its words and key."""
    of_hits = {"word_count": word_count("text"), "key": text_key("text")}
    found = bm25(documents(spark, sf_dir), "text", TERMS, of_hits)
    return found.withColumn("score", r6("score")).withColumn("grp", F.coalesce("source", F.lit("")))


def _ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir).filter(F.col("word_count") >= LEAST_WORDS)


def bm25_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every matching document with its score."""
    return bm25(documents(spark, sf_dir), "text", TERMS).select("doc_id", "doc_len", r6("score").alias("score"))


def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sixty best documents of sixty words or more."""
    return _ranked(spark, sf_dir).orderBy("score", "doc_id").limit(LIMIT).select("doc_id", "score", "word_count")


def bm25_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sixty best, at most ten of a source, no text twice."""
    rows = _ranked(spark, sf_dir).select("doc_id", "grp", "key", "score")
    return capped_distinct(rows, ["score", "doc_id"], "grp", "key", PER_SOURCE, LIMIT).select("rank", "doc_id", "grp", "score")


def _recall(spark: SparkSession, sf_dir: str, docs: DataFrame, *cited: Column) -> DataFrame:
    """The first of `docs` of each combination of `cited` as a citation to be found."""
    gold = docs.groupBy(*cited).agg(F.min_by(F.struct("doc_id", "word_count"), "doc_id").alias("x")).select("x.doc_id", "x.word_count")
    matches = _scores(spark, sf_dir).select("doc_id", "grp", "key", "score", "word_count")
    rows = matches.filter(F.col("word_count") >= LEAST_WORDS).drop("word_count")
    capped = capped_distinct(rows, ["score", "doc_id"], "grp", "key", PER_SOURCE, LIMIT)
    free = capped_distinct(rows, ["score", "doc_id"], "grp", "key", LIMIT, LIMIT)
    return recall_report(gold, capped, free, matches.select("doc_id"), ["doc_id"], LEAST_WORDS).select("doc_id", "word_count", "found_rank", "outcome")


# -- the search view: the main speaker's segments of the better tiers ---------------------


def search_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of speaker K in transcripts of tiers A and B, which is what search reads, with their transcript's item and tier."""
    spoken = table(spark, sf_dir, "segments", "id", "transcript_id", "speaker_code", "text", "t_start").filter("speaker_code = 'K'").drop("speaker_code").dropDuplicates(["id"])
    held = table(spark, sf_dir, "transcripts", "id", "item_code", "corpus_tier").dropDuplicates(["id"]).filter("corpus_tier in ('A', 'B')")
    held = held.select(F.col("id").alias("transcript_id"), F.upper(F.trim("item_code")).alias("item_code"), "corpus_tier")
    return spoken.join(held, "transcript_id")


def _index(spark: SparkSession, rows: DataFrame) -> Index:
    return Index.of(rows, "id", "text").write(f"{shared_dir(spark).rstrip('/')}/index-{uuid.uuid4().hex}")


def search_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sixty best segments of the search view, at most two of an item and no text twice, each with its item's title and year, its time and a link to it."""
    view = materialize(search_view(spark, sf_dir), "search-view")
    found = _index(spark, view).search(TERMS).withColumn("score", r6("score"))
    rows = view.select("id", "transcript_id", "item_code", "t_start", word_count("text").alias("word_count"), text_key("text").alias("key"))
    rows = rows.join(found.select("id", "score"), "id").filter(F.col("word_count") >= LEAST_HIT_WORDS).withColumn("grp", F.coalesce("item_code", F.lit("")))
    best = capped_distinct(rows, ["score", "id"], "grp", "key", PER_ITEM, LIMIT)
    latest = table(spark, sf_dir, "items", "id", "code", "title", "year", "updated_at").groupBy("id").agg(F.max_by(F.struct("code", "title", "year"), "updated_at").alias("x"))
    items = latest.select("id", F.upper(F.trim("x.code")).alias("item_code"), "x.title", "x.year").groupBy("item_code").agg(F.min_by(F.struct("id", "title", "year"), "id").alias("item"))
    media = table(spark, sf_dir, "item_media").filter("status = 'downloaded' and media = 'video' and item_id is not null")
    links = best_per_key(media, "item_id", "future_path", [F.col("id"), F.col("future_path")])
    rows = best.join(items, "item_code", "left").join(links, F.col("item.id") == F.col("item_id"), "left")
    return rows.select(
        "rank", F.col("id").alias("segment_id"), "item_code", F.col("item.title").alias("title"), F.col("item.year").alias("year"), "word_count", "score",
        timecode("t_start").alias("at"), timed_url(LINK_BASE, "future_path", "t_start").alias("link"),
    )


def index_after_purge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of the search index that begin with the concept's terms, before and after the transcripts of tier B are purged from it."""
    view = materialize(search_view(spark, sf_dir), "search-view")
    index = _index(spark, view)
    left, _ = purge(index, view.filter("corpus_tier = 'B'").select("id"))
    terms = F.explode(F.filter(F.array(*(F.lit(t) for t in TERMS)), lambda t: F.startswith(F.col("term"), t)))
    stated = lambda x, state: x.postings.select("id", "tf", terms.alias("prefix")).groupBy("prefix").agg(F.count_distinct("id").alias("segments"), F.sum("tf").alias("occurrences")).withColumn("state", F.lit(state))
    return stated(index, "before").unionByName(stated(left, "after"))


def _item() -> Column:
    return F.upper(F.trim("item_code")).alias("item")


def recall_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first document of every item, of whatever kind, as a citation to be found: which are, and why the others are not."""
    return _recall(spark, sf_dir, documents(spark, sf_dir).filter("item_code is not null").withColumn("word_count", word_count("text")), _item())


def recall_gaps_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first letter, study note and dialogue of every item as citations to be found: which are, and why the others are not."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "item_code", "doc_kind").withColumn("word_count", word_count("text"))
    return _recall(spark, sf_dir, docs.filter(F.col("item_code").isNotNull() & F.col("doc_kind").isin(CITED_KINDS)), _item(), F.col("doc_kind"))


def _summary(rows: DataFrame) -> DataFrame:
    worst = F.max("found_rank")
    return rows.groupBy("outcome").agg(F.count("*").alias("citations"), worst.alias("worst_rank"), F.coalesce(LIMIT - worst < LIMIT // 10, F.lit(False)).alias("thin"))


def recall_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citations by outcome, with the deepest rank and whether it leaves less than a tenth of the list."""
    return _summary(recall_gaps(spark, sf_dir))


def recall_summary_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of the citations of each kind."""
    return _summary(recall_gaps_by_kind(spark, sf_dir))


def prefix_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each term of the concept the documents and words that begin with it: over the distinct vocabulary, not the texts."""
    terms = spark.createDataFrame([(t,) for t in TERMS], "term string")
    index = postings(documents(spark, sf_dir), "doc_id", "text")
    vocabulary = index.select(F.col("term").alias("word")).distinct()
    matched = vocabulary.join(F.broadcast(terms), F.col("word").startswith(F.col("term")))
    found = index.join(matched, index.term == matched.word).select(matched.term, "word", "id", "tf")
    return found.groupBy("term").agg(F.count_distinct("id").alias("documents"), F.count_distinct("word").alias("words"), F.sum("tf").alias("occurrences"))


def posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document frequency and occurrences of every word."""
    return postings(documents(spark, sf_dir), "doc_id", "text").groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"), F.max("tf").alias("most"))


def place_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The query terms of every place: of its name, other names and region."""
    names = F.concat(F.array("place_name"), F.split(F.coalesce("other_names", F.lit("")), ";"), F.array("region_name"))
    forms = table(spark, sf_dir, "places").select("place_code", F.posexplode(names).alias("position", "form"))
    return registry_terms(forms, "place_code", "position", "form")


def recall_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the citations how many are found, in whole percent, the deepest rank, and how far it is from the end of the list."""
    rows = recall_gaps(spark, sf_dir).agg(F.count("*").alias("cited"), F.count("found_rank").alias("found"), F.coalesce(F.max("found_rank"), F.lit(0)).alias("worst_rank"))
    head = F.lit(LIMIT) - F.col("worst_rank")
    return rows.select("cited", "found", F.coalesce(F.floor(F.try_divide(100 * F.col("found"), F.col("cited"))), F.lit(0)).cast("bigint").alias("pct"), "worst_rank", head.alias("headroom"), ((F.col("found") > 0) & (head < LIMIT // 10)).alias("thin"))


def stopword_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of documents that have each stopword, and whether it is ubiquitous (more than 4 in 100)."""
    docs = documents(spark, sf_dir).select(F.array_distinct(tokens("text")).alias("toks"))
    has = docs.select(F.explode(F.transform(F.array(*(F.lit(w) for w in STOPWORDS)), lambda w: F.struct(w.alias("word"), F.array_contains("toks", w).cast("int").alias("has")))).alias("x"))
    rows = has.groupBy("x.word").agg(F.sum("x.has").alias("documents"), F.avg("x.has").alias("share"))
    return rows.select("word", "documents", r6("share").alias("share"), (F.col("share") > 0.04).alias("ubiquitous"))


def link_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links in documents by host."""
    urls = F.regexp_extract_all("text", F.lit(r"(?:https?://|www\.)([a-z0-9.-]+)"), 1)
    rows = documents(spark, sf_dir).select("doc_id", F.explode(urls).alias("host"))
    return rows.groupBy("host").agg(F.count("*").alias("links"), F.count_distinct("doc_id").alias("documents"))


def text_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose text, up to blanks, came before: doc_id and the first document that has it."""
    key = F.sha2(F.trim(F.regexp_replace("text", r"\s+", " ")), 256)
    rows = documents(spark, sf_dir).filter("text is not null").select("doc_id", key.alias("key"))
    first = rows.groupBy("key").agg(F.min("doc_id").alias("first_doc"))
    return rows.join(first, "key").filter("doc_id <> first_doc").select("doc_id", "first_doc")


QUERIES = {
    "bm25_scores": bm25_scores, "bm25_topk": bm25_topk, "bm25_capped": bm25_capped, "recall_gaps": recall_gaps, "recall_summary": recall_summary, "recall_gaps_by_kind": recall_gaps_by_kind, "recall_summary_by_kind": recall_summary_by_kind, "prefix_df": prefix_df,
    "search_hits": search_hits, "index_after_purge": index_after_purge, "posting_lists": posting_lists, "stopword_share": stopword_share, "place_terms": place_terms, "recall_rate": recall_rate, "link_hosts": link_hosts, "text_copies": text_copies,
}

_TOKS = r"list_filter(regexp_split_to_array(strip_accents(lower(coalesce(text, ''))), '[^\pL\pN]+'), lambda x: x <> '')"
_N = r"len(regexp_extract_all(coalesce(text, ''), '\S+'))"


def _bm25_sql(rows: str = "SELECT doc_id, coalesce(source, '') AS grp, text, item_code FROM documents", least: int = LEAST_WORDS) -> str:
    f = ", ".join(f"len(list_filter(toks, lambda x: starts_with(x, '{t}'))) AS f{i}" for i, t in enumerate(TERMS))
    n = ", ".join(f"count(*) FILTER (f{i} > 0) AS n{i}" for i in range(len(TERMS)))
    idf = lambda i: f"CASE WHEN ln((s.n - n{i} + 0.5) / (n{i} + 0.5)) > 0 THEN ln((s.n - n{i} + 0.5) / (n{i} + 0.5)) ELSE 1e-6 END"
    part = lambda i: f"({idf(i)}) * f{i} * 2.2::DOUBLE / (f{i} + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * d / s.mean))"
    return f"""t AS (SELECT *, {_N} AS word_count, {_TOKS} AS toks FROM ({rows})),
      c AS (SELECT * EXCLUDE (toks), len(toks) AS d, {f} FROM t), s AS (SELECT count(*)::DOUBLE AS n, avg(d) AS mean, {n} FROM c),
      hit AS (SELECT doc_id, grp, text, word_count, CAST(d AS INT) AS doc_len, round(-({" + ".join(part(i) for i in range(len(TERMS)))}), 6) AS score FROM c, s WHERE {" OR ".join(f"f{i} > 0" for i in range(len(TERMS)))}),
      rk AS (SELECT doc_id, grp, score, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS key, row_number() OVER (ORDER BY score, doc_id) AS n FROM hit WHERE word_count >= {least})"""


def _capped_sql(name: str, cap: int) -> str:
    """Walks the ranked list, carrying the groups and texts that were taken."""
    taken = f"len(w.groups) < {LIMIT} AND NOT list_contains(w.keys, r.key) AND len(list_filter(w.groups, lambda g: g = r.grp)) < {cap}"
    return f"""{name}_walk AS (
        SELECT 0::BIGINT AS n, NULL::BIGINT AS doc_id, NULL::VARCHAR AS grp, NULL::DOUBLE AS score, []::VARCHAR[] AS groups, []::VARCHAR[] AS keys, false AS taken
        UNION ALL SELECT r.n, r.doc_id, r.grp, r.score, CASE WHEN {taken} THEN list_append(w.groups, r.grp) ELSE w.groups END, CASE WHEN {taken} THEN list_append(w.keys, r.key) ELSE w.keys END, {taken}
        FROM {name}_walk w JOIN rk r ON r.n = w.n + 1 WHERE len(w.groups) < {LIMIT}),
      {name} AS (SELECT CAST(row_number() OVER (ORDER BY n) AS INT) AS rank, doc_id, grp, score FROM {name}_walk WHERE taken)"""


_VIEW = """SELECT s.id AS doc_id, coalesce(upper(trim(t.item_code)), '') AS grp, s.text, upper(trim(t.item_code)) AS item_code, s.t_start, t.corpus_tier
  FROM (SELECT DISTINCT id, transcript_id, text, t_start FROM segments WHERE speaker_code = 'K') s JOIN (SELECT DISTINCT * FROM transcripts WHERE corpus_tier IN ('A', 'B')) t ON t.id = s.transcript_id"""
_HITS = f"""WITH RECURSIVE {_bm25_sql(_VIEW, LEAST_HIT_WORDS)}, {_capped_sql("capped", PER_ITEM)},
  it AS (SELECT upper(trim(code)) AS code, id, title, year FROM (SELECT * FROM items QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) = 1) QUALIFY row_number() OVER (PARTITION BY upper(trim(code)) ORDER BY id) = 1),
  link AS (SELECT item_id, arg_min(future_path, (id, future_path)) AS path FROM item_media WHERE status = 'downloaded' AND media = 'video' AND item_id IS NOT NULL GROUP BY item_id),
  x AS (SELECT t.*, CAST(trunc(t.t_start) AS BIGINT) AS s FROM t)
  SELECT c.rank, c.doc_id AS segment_id, x.item_code, it.title, it.year, x.word_count, c.score,
    (s // 3600) || ':' || lpad((s % 3600 // 60)::VARCHAR, 2, '0') || ':' || lpad((s % 60)::VARCHAR, 2, '0') AS at, '{LINK_BASE}' || link.path || '?t=' || s AS link
  FROM capped c JOIN x ON x.doc_id = c.doc_id LEFT JOIN it ON it.code = x.item_code LEFT JOIN link ON link.item_id = it.id"""
_FIRST_OF_ITEM = "SELECT min(doc_id) AS doc_id FROM t WHERE item_code IS NOT NULL GROUP BY upper(trim(item_code))"
_FIRST_OF_KIND = f"SELECT min(doc_id) AS doc_id FROM documents WHERE item_code IS NOT NULL AND doc_kind IN ({', '.join(repr(k) for k in CITED_KINDS)}) GROUP BY upper(trim(item_code)), doc_kind"


def _recall_sql(gold: str = _FIRST_OF_ITEM) -> str:
    return f"""WITH RECURSIVE {_bm25_sql()}, {_capped_sql("capped", PER_SOURCE)}, {_capped_sql("uncapped", LIMIT)},
      gold AS ({gold}),
      gaps AS (SELECT gold.doc_id, t.word_count, c.rank AS found_rank, CASE WHEN c.rank IS NOT NULL THEN 'found' WHEN t.word_count < {LEAST_WORDS} THEN 'min_words' WHEN u.rank IS NOT NULL THEN 'per_item' WHEN h.doc_id IS NOT NULL THEN 'rank' ELSE 'vocabulary' END AS outcome
        FROM gold JOIN t USING (doc_id) LEFT JOIN capped c USING (doc_id) LEFT JOIN uncapped u USING (doc_id) LEFT JOIN hit h USING (doc_id))"""


ORACLE = {
    "bm25_scores": f"WITH {_bm25_sql()} SELECT doc_id, doc_len, score FROM hit",
    "bm25_topk": f"WITH {_bm25_sql()} SELECT doc_id, score, word_count FROM hit WHERE word_count >= {LEAST_WORDS} ORDER BY score, doc_id LIMIT {LIMIT}",
    "bm25_capped": f"WITH RECURSIVE {_bm25_sql()}, {_capped_sql('capped', PER_SOURCE)} SELECT * FROM capped",
    "recall_gaps": f"{_recall_sql()} SELECT * FROM gaps",
    "recall_summary": f"{_recall_sql()} SELECT outcome, count(*) AS citations, max(found_rank) AS worst_rank, coalesce({LIMIT} - max(found_rank) < {LIMIT // 10}, false) AS thin FROM gaps GROUP BY outcome",
    "recall_gaps_by_kind": f"{_recall_sql(_FIRST_OF_KIND)} SELECT * FROM gaps",
    "recall_summary_by_kind": f"{_recall_sql(_FIRST_OF_KIND)} SELECT outcome, count(*) AS citations, max(found_rank) AS worst_rank, coalesce({LIMIT} - max(found_rank) < {LIMIT // 10}, false) AS thin FROM gaps GROUP BY outcome",
    "place_terms": rf"""WITH n AS (SELECT place_code, list_concat([place_name], string_split(coalesce(other_names, ''), ';'), [region_name]) AS fs FROM places), f AS (SELECT place_code, unnest(fs) AS form, generate_subscripts(fs, 1) AS pos FROM n),
      w AS (SELECT place_code, pos, regexp_extract_all(lower(form), '[\pL\pN]+') AS ws FROM f), t AS (SELECT place_code, pos, unnest(ws) AS term, generate_subscripts(ws, 1) AS i FROM w),
      k AS (SELECT place_code, term, min((pos, i)) AS first_at FROM t WHERE length(term) >= 3 AND (term NOT IN ({", ".join(repr(w) for w in STOPWORDS)}) OR (place_code, term) IN (SELECT (place_code, ws[1]) FROM w WHERE len(ws) = 1)) GROUP BY ALL)
      SELECT place_code, CAST(row_number() OVER (PARTITION BY place_code ORDER BY first_at) AS INT) AS place, term FROM k""",
    "recall_rate": f"{_recall_sql()}, r AS (SELECT count(*) AS cited, count(found_rank) AS found, coalesce(max(found_rank), 0) AS worst_rank FROM gaps) SELECT cited, found, CASE WHEN cited = 0 THEN 0 ELSE 100 * found // cited END AS pct, worst_rank, {LIMIT} - worst_rank AS headroom, found > 0 AND {LIMIT} - worst_rank < {LIMIT // 10} AS thin FROM r",
    "search_hits": _HITS,
    "index_after_purge": f"""WITH v AS ({_VIEW}), w AS (SELECT doc_id, corpus_tier, unnest({_TOKS}) AS word FROM v),
      m AS (SELECT prefix, doc_id, corpus_tier FROM w JOIN (SELECT unnest([{', '.join(repr(t) for t in TERMS)}]) AS prefix) ON starts_with(word, prefix))
      SELECT prefix, count(DISTINCT doc_id) AS segments, count(*) AS occurrences, 'before' AS state FROM m GROUP BY prefix
      UNION ALL SELECT prefix, count(DISTINCT doc_id), count(*), 'after' FROM m WHERE corpus_tier <> 'B' GROUP BY prefix""",
    "prefix_df": f"WITH t AS (SELECT doc_id, unnest({_TOKS}) AS word FROM documents) SELECT term, count(DISTINCT doc_id) AS documents, count(DISTINCT word) AS words, count(*) AS occurrences FROM t JOIN (SELECT unnest([{', '.join(repr(t) for t in TERMS)}]) AS term) ON starts_with(word, term) GROUP BY term",
    "posting_lists": f"WITH t AS (SELECT doc_id, unnest({_TOKS}) AS term FROM documents), p AS (SELECT term, doc_id, count(*) AS tf FROM t GROUP BY ALL) SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf, max(tf) AS most FROM p GROUP BY term",
    "stopword_share": f"WITH t AS (SELECT {_TOKS} AS toks FROM documents), w AS (SELECT unnest([{', '.join(repr(w) for w in STOPWORDS)}]) AS word) SELECT word, count(*) FILTER (list_contains(toks, word)) AS documents, round(avg(list_contains(toks, word)::INT), 6) AS share, avg(list_contains(toks, word)::INT) > 0.04 AS ubiquitous FROM t, w GROUP BY word",
    "link_hosts": r"WITH t AS (SELECT doc_id, unnest(regexp_extract_all(text, '(?:https?://|www\.)([a-z0-9.-]+)', 1)) AS host FROM documents) SELECT host, count(*) AS links, count(DISTINCT doc_id) AS documents FROM t GROUP BY host",
    "text_copies": r"WITH t AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY trim(regexp_replace(text, '\s+', ' ', 'g'))) AS first_doc FROM documents WHERE text IS NOT NULL) SELECT * FROM t WHERE doc_id <> first_doc",
}
