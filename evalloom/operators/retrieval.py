"""Batch keyword retrieval: many queries against one corpus.

Queries are `query_id, keywords ARRAY<STRING>`; a corpus is `corpus_pos, content`, where `corpus_pos` is a
unique integer that fixes the corpus order. A corpus that also has `n_chars`, the length of the content,
need not have its text read where only lengths are asked for. Until the last step only `(query, position, score, length)`
moves between tasks, never text. With the stored index of `postings` the text is not even read until then; an index costs
more than some passes over the text, so it is for a corpus that many query sets are put to.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evalloom import constants as K
from evalloom.functions.text import fill_prompt, words
from evalloom.operators.postings import GRAM, KeywordIndex, grams as _grams
from evalloom.operators.sampling import first_n, top_per_group
from evalloom.session import stage

# Documents are dealt into this many slices; what a slice drops of a query, the query would drop.
SLICES = 256


def salient_keywords(
    queries: DataFrame, docs: DataFrame, k: int, *, text: str = "text", content: str = "content",
    stop_words: tuple[str, ...] = (), index: KeywordIndex | None = None,
) -> DataFrame:
    """The k words of each query that the fewest documents hold, rarest first; ties by word.

    Words no document holds retrieve nothing and are left out. Queries whose words are all unknown get
    an empty list. With an `index` of the documents their text is not read.
    """
    asked = queries.select("query_id", F.explode(F.array_distinct(words(text))).alias("word"))
    if stop_words:
        asked = asked.filter(~F.col("word").isin(*stop_words))
    # Only the asked words are counted: the corpus vocabulary never crosses the network.
    frequency = index.frequencies if index else (
        docs.select(F.explode(F.array_distinct(words(content))).alias("word"))
        .join(asked.select("word").distinct(), "word", "left_semi")
        .groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    )
    known = asked.join(frequency, "word")
    order = [F.col("df"), F.col("word")]
    ranked = top_per_group(known, ["query_id"], order, k, F.col("word"), 8)
    picked = ranked.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("df", "word"))).alias("picked")
    )
    kept = queries.select("query_id").join(picked, "query_id", "left")
    return kept.select(
        "query_id", F.coalesce(F.col("picked.word"), F.array().cast("array<string>")).alias("keywords")
    )


def _n_chars(docs: DataFrame) -> Column:
    known = F.col("n_chars").cast("int") if "n_chars" in docs.columns else F.length("content")
    return known.alias("n_chars")


def _runs(text: Column) -> Column:
    """Runs of white space and runs of anything else: text without both kinds lies inside one run."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"(\s+|\S+)"), 1))


def _tokens(text: Column) -> Column:
    """Runs without white space, perhaps with an empty one. Much faster than looking for both kinds."""
    return F.array_distinct(F.split(text, r"\s+"))


def _hits_by_scan(docs: DataFrame, keywords: list[str]) -> DataFrame:
    """One pass over the corpus testing a short keyword list; no shuffle."""
    wanted = F.array(*[F.lit(word) for word in keywords])
    # The outer lambda binds the lowered text, so that it is lowered once and not once per keyword.
    held = F.transform(
        F.array(F.lower("content")),
        lambda text: F.filter(wanted, lambda word: F.contains(text, word)),
    )[0]
    return docs.select("corpus_pos", _n_chars(docs), F.explode(held).alias("keyword"))


def _pieces(keywords: DataFrame) -> DataFrame:
    """`keyword, piece, spaced`: the longest piece of each keyword without white space.

    A keyword that is all white space is its own piece, and `spaced`.
    """
    sized = F.transform(
        _runs(F.col("keyword")), lambda t: F.struct(F.length(t).alias("size"), t.alias("piece"))
    )
    spaced = F.size(F.filter(sized, lambda t: ~t["piece"].rlike(r"^\s"))) == 0
    longest = F.array_max(F.when(spaced, sized).otherwise(F.filter(sized, lambda t: ~t["piece"].rlike(r"^\s"))))
    return keywords.select("keyword", longest["piece"].alias("piece"), spaced.alias("spaced"))


def _slice() -> Column:
    return F.pmod(F.xxhash64("corpus_pos"), F.lit(SLICES))


def _sliced(hits: DataFrame) -> DataFrame:
    """Each (document, keyword) once, `exact` if one of its tokens settles it; documents dealt by slice."""
    return hits.withColumn("slice", _slice()).repartition("slice").groupBy("slice", "corpus_pos", "n_chars", "keyword").agg(
        F.max("exact").alias("exact")
    )


def _settled(hits: DataFrame, all_exact: bool, docs: DataFrame) -> DataFrame:
    """The hits that hold. Only keywords of several pieces need a look at the text of their candidates."""
    if all_exact:
        return hits.drop("exact")
    hits = stage(hits, "hits")  # read twice
    sure = hits.filter("exact").drop("exact")
    doubtful = stage(hits.filter(~F.col("exact")).drop("exact"), "phrase-candidates")
    verified = doubtful.join(docs.select("corpus_pos", F.lower("content").alias("text")), "corpus_pos")
    return sure.unionByName(verified.filter(F.contains("text", "keyword")).drop("text"))


def _hits_by_vocabulary(docs: DataFrame, keywords: DataFrame) -> DataFrame:
    """Match any number of keywords through the corpus vocabulary, with equi-joins only.

    A keyword is looked up by its longest piece without white space. (One that is all white space is looked
    up whole, among the runs of white space.) That piece lies inside one token of every text that holds the
    keyword, so it is matched against the distinct tokens, which share a gram with it. The few (token,
    keyword) pairs are staged, so the pass over the corpus that follows broadcasts them if
    they are small. Only keywords that hold several pieces need a second look at the text.
    """
    looked_up = _pieces(keywords).withColumn("gram", F.substring("piece", 1, GRAM))
    # What has to be looked up, at most 2 * GRAM rows: gram sizes, and whether white space is a keyword.
    kinds = looked_up.select(F.length("gram").alias("n"), "spaced").distinct().collect()
    sizes = sorted({row.n for row in kinds})
    split = _runs if any(row.spaced for row in kinds) else _tokens
    spread = docs.select("corpus_pos", _n_chars(docs), F.explode(split(F.lower("content"))).alias("token"))
    vocabulary = spread.select("token").distinct()
    grams = vocabulary.select("token", F.explode(_grams(F.col("token"), sizes)).alias("gram"))
    pairs = stage(
        grams.join(looked_up, "gram")
        .filter(F.contains("token", "piece"))
        .select("token", "keyword", (F.col("piece") == F.col("keyword")).alias("exact")),
        "token-keywords",
    )
    all_exact = pairs.filter(~F.col("exact")).isEmpty()
    return _settled(_sliced(spread.join(pairs, "token").drop("token")), all_exact, docs)


def _hits_by_index(docs: DataFrame, keywords: DataFrame, index: KeywordIndex) -> DataFrame:
    """Match keywords through the stored index.

    The postings hold no white space, so a keyword that is nothing else is looked for in the text.
    """
    pieces = _pieces(keywords)
    found, doubtful, spaced = index.lookup(pieces)
    hits = _settled(_sliced(found), not doubtful, docs)
    return hits.unionByName(_hits_by_vocabulary(docs, pieces.filter("spaced").select("keyword"))) if spaced else hits


def _matches(
    queries: DataFrame, docs: DataFrame, scan_limit: int, index: KeywordIndex | None, hits: DataFrame | None = None,
) -> DataFrame:
    """`slice, query_id, corpus_pos, n_chars, score`, in one shuffle of the documents' hits by slice.

    Pairs of a query and a document come up and are counted inside their slice, and may be cut there.
    """
    wanted = _wanted(queries)
    if hits is not None:
        hits = hits.withColumn("slice", _slice()).repartition("slice")
    else:
        if index is not None:
            wanted = stage(wanted, "wanted-keywords")
        hits = _hits(wanted.select("keyword").distinct(), docs, scan_limit, index)
    return hits.join(wanted, "keyword").groupBy("slice", "query_id", "corpus_pos", "n_chars").agg(F.sum("times").alias("score"))


def _wanted(queries: DataFrame) -> DataFrame:
    """`query_id, keyword, times`: the keywords as they are compared, without empty ones."""
    return (
        queries.select("query_id", F.explode("keywords").alias("keyword"))
        .withColumn("keyword", F.lower("keyword"))
        .filter(F.col("keyword") != "")
        .groupBy("query_id", "keyword").agg(F.count(F.lit(1)).alias("times"))
    )


def _hits(keywords: DataFrame, docs: DataFrame, scan_limit: int, index: KeywordIndex | None = None) -> DataFrame:
    """`slice, corpus_pos, n_chars, keyword` of every document that holds a keyword."""
    if index is not None:
        return _hits_by_index(docs, keywords, index)
    sample = [row.keyword for row in keywords.limit(scan_limit + 1).collect()]
    if len(sample) <= scan_limit:
        return _sliced(_hits_by_scan(docs, sorted(sample)).withColumn("exact", F.lit(True))).drop("exact")
    return _hits_by_vocabulary(docs, keywords)


def keyword_hits(query_sets: Sequence[DataFrame], docs: DataFrame, *, scan_limit: int = 64) -> DataFrame:
    """`corpus_pos, n_chars, keyword` for the keywords of several query sets at once, staged.

    Given as `hits` to `keyword_matches` and `keyword_rank`, one pass over the text serves all the sets.
    """
    keywords = [_wanted(queries).select("keyword") for queries in query_sets]
    asked = stage(reduce(DataFrame.union, keywords).distinct(), "asked-keywords")
    return stage(_hits(asked, docs, scan_limit).drop("slice"), "keyword-hits")


def keyword_matches(
    queries: DataFrame, docs: DataFrame, *, scan_limit: int = 64, index: KeywordIndex | None = None, hits: DataFrame | None = None,
) -> DataFrame:
    """Documents that hold at least one keyword of a query, with the keyword score.

    The score counts the query's keywords that occur in the text, letter case aside, inside words too; a
    repeated keyword counts each time. With an `index` of `docs` the keywords are looked up there. Without one, up to
    `scan_limit` distinct keywords are tested in one scan of the corpus, and more go through its vocabulary. All ways
    give the same rows. `hits` are those of `keyword_hits`, if the keywords have been looked up already.
    """
    return _matches(queries, docs, scan_limit, index, hits).drop("slice")


def _add_unmatched(matched: DataFrame, queries: DataFrame, head: DataFrame, blank: DataFrame | None = None) -> DataFrame:
    """Offer the documents of `head` and `blank` to every query with score 0, unless they matched it.

    `head` is a bounded start of the corpus: one array that every query unfolds where it lies. `blank` may have any
    number of documents; they meet the queries in a grid.
    """
    asking = queries.filter(F.size("keywords") > 0).select("query_id")
    offered = head.agg(F.collect_list(F.struct("corpus_pos", F.col("n_chars").cast("int").alias("n_chars"))).alias("held")).scalar()
    rows = [asking.select("query_id", F.explode(offered).alias("d")).select("query_id", "d.corpus_pos", "d.n_chars")]
    if blank is not None:
        down, across = F.pmod(F.xxhash64("query_id"), F.lit(64)), F.pmod(F.xxhash64("corpus_pos"), F.lit(4))
        rows.append(
            asking.select("query_id", down.alias("down"), F.explode(F.expr("sequence(0L, 3L)")).alias("across"))
            .join(blank.select("corpus_pos", F.col("n_chars").cast("int").alias("n_chars"), across.alias("across"),
                               F.explode(F.expr("sequence(0L, 63L)")).alias("down")), ["down", "across"])
            .select("query_id", "corpus_pos", "n_chars")
        )
    for added in rows:
        matched = matched.unionByName(added.withColumn("score", F.lit(0).cast("bigint")))
    return matched.groupBy("query_id", "corpus_pos", "n_chars").agg(F.max("score").alias("score"))


def _add_blank_hits(ranked: DataFrame, queries: DataFrame) -> DataFrame:
    """The empty keyword is in every text: it raises all scores of its query alike."""
    blanks = queries.select(
        "query_id", F.size(F.filter("keywords", lambda word: word == "")).cast("bigint").alias("__blank")
    ).filter("__blank > 0")
    return ranked.join(blanks, "query_id", "left").withColumn(
        "score", F.col("score") + F.coalesce("__blank", F.lit(0))
    ).drop("__blank")


def _order() -> list[Column]:
    return [F.col("score").desc(), F.col("corpus_pos").asc()]


def keyword_rank(
    queries: DataFrame, docs: DataFrame, k: int, *, min_score: int = 0, scan_limit: int = 64,
    index: KeywordIndex | None = None, hits: DataFrame | None = None,
) -> DataFrame:
    """The k best documents of each query: score descending, ties in corpus order.

    Documents without a match follow in corpus order unless `min_score` is 1. Of those, the k best can
    only hold documents among the first k of the corpus, so only these are offered. `index` and `hits` are as in
    `keyword_matches`.
    """
    sized = index.documents if index else docs.select("corpus_pos", _n_chars(docs))
    matched = _matches(queries, docs, scan_limit, index, hits)
    in_slice = F.row_number().over(W.partitionBy("slice", "query_id").orderBy(*_order()))
    best = matched.withColumn("place", in_slice).filter(F.col("place") <= k).drop("place", "slice")
    if min_score <= 0:
        head = first_n(sized, k)
        best = _add_unmatched(best, queries, head)
    best = _add_blank_hits(best, queries)
    place = F.row_number().over(W.partitionBy("query_id").orderBy(*_order()))
    return best.withColumn("rank", place).filter(F.col("rank") <= k).select(
        "query_id", "rank", "corpus_pos", "score", "n_chars"
    )


def fit_budget(
    ranked: DataFrame, budget: int, *, group: str = "query_id", order: list[Column] | None = None,
    spread: str = "corpus_pos", salts: int = SLICES,
) -> DataFrame:
    """Keep the best documents of each query until `budget` characters are used.

    Adds `rank` and `kept_chars`. The document that overflows is cut, and is the last one; if the budget
    is used up exactly, the next document follows with no characters left. `ranked` needs `n_chars` and
    `spread`, and `order` must be unique.

    A query's documents are cut into slices first. The characters before a document inside its slice are
    at most those before it overall, so dropping what overflows a slice drops nothing that is kept, and
    only about `salts * budget` characters' worth of rows per query meet in one task. Rows that have a `slice`
    already are cut by that.
    """
    order = order or _order()

    def before(*keys: str) -> Column:
        window = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
        return F.coalesce(F.sum("n_chars").over(window), F.lit(0))

    if "slice" not in ranked.columns:
        ranked = ranked.withColumn("slice", F.pmod(F.xxhash64(spread), F.lit(salts)))
    sliced = (
        ranked.withColumn("__before", before("slice", group))
        .filter(F.col("__before") <= budget)
        .drop("slice", "__before")
    )
    placed = sliced.withColumn("__before", before(group)).withColumn(
        "rank", F.row_number().over(W.partitionBy(group).orderBy(*order))
    )
    kept = placed.filter(F.col("__before") <= budget)
    return kept.withColumn(
        "kept_chars", F.least(F.col("n_chars"), F.lit(budget) - F.col("__before")).cast("int")
    ).drop("__before")


def _corpus_head(sized: DataFrame, budget: int) -> tuple[DataFrame, DataFrame]:
    """The start of the corpus that can fill `budget` characters: its documents with text, and those without.

    An unmatched document is kept only if everything before it, matched or not, fits. At most
    `budget + 1` documents with text do that, and those come from a top-n by position. Documents
    without text use nothing up, so all that lie before the last of them stay in.
    """
    ahead = W.orderBy("corpus_pos").rowsBetween(W.unboundedPreceding, -1)
    filled = first_n(sized.filter(F.col("n_chars") > 0), budget + 1).withColumn("used", F.coalesce(F.sum("n_chars").over(ahead), F.lit(0)))
    filled = stage(filled.filter(F.col("used") <= budget).drop("used"), "corpus-head")
    whole = F.sum("n_chars") <= budget  # then the corpus may end before the budget does
    last = filled.agg(F.when(F.coalesce(whole, F.lit(True)), F.lit(None)).otherwise(F.max("corpus_pos"))).scalar()
    return filled, sized.filter((F.col("n_chars") == 0) & (last.isNull() | (F.col("corpus_pos") <= last)))


def retrieve_context(
    queries: DataFrame, docs: DataFrame, *, budget: int = K.MAX_CONTEXT_CHARS, min_score: int = 0,
    scan_limit: int = 64, index: KeywordIndex | None = None,
) -> DataFrame:
    """Rank the corpus for each query and keep what fits the context budget.

    Returns `query_id, rank, corpus_pos, score, kept_chars`. With `min_score=0` documents without a match
    follow the matched ones in corpus order while there is budget left; with 1 they do not. A query
    without keywords gets nothing. `index` is as in `keyword_matches`.
    """
    matched = _matches(queries, docs, scan_limit, index)
    if min_score <= 0:
        sized = index.documents if index else docs.select("corpus_pos", _n_chars(docs))
        # Cut the matches first: a query's rows then stay few when the corpus head joins them.
        best = fit_budget(matched, budget).drop("rank", "kept_chars")
        matched = _add_unmatched(best, queries, *_corpus_head(sized, budget))
    kept = fit_budget(matched, budget)
    return _add_blank_hits(kept, queries).select("query_id", "rank", "corpus_pos", "score", "kept_chars")


def with_text(kept: DataFrame, docs: DataFrame, text: str = "page_content") -> DataFrame:
    """Add the kept part of each document's text.

    The kept rows are staged first, so Spark knows how few they are and does not shuffle the corpus.
    """
    small = stage(kept, "kept-documents")
    joined = docs.select("corpus_pos", "content").join(small, "corpus_pos")
    return joined.withColumn(text, F.substring("content", F.lit(1), F.col("kept_chars"))).drop("content")


def build_prompts(queries: DataFrame, kept: DataFrame, docs: DataFrame, *, text: str = "text") -> DataFrame:
    """One prompt per query: the kept texts in rank order, blank lines between, then the question."""
    pieces = with_text(kept, docs).groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "page_content"))).alias("pieces")
    )
    context = F.coalesce(F.array_join("pieces.page_content", "\n\n"), F.lit(""))
    return queries.join(pieces, "query_id", "left").select(
        "query_id", fill_prompt(context, text).alias("prompt")
    )


def fuse_ranks(keyword: DataFrame, vector: DataFrame, k: int, item: str) -> DataFrame:
    """The k best by reciprocal rank fusion of two ranked lists `query_id, <item>, rank`."""
    left = keyword.select("query_id", item, F.col("rank").alias("keyword_rank"))
    right = vector.select("query_id", item, F.col("rank").alias("vector_rank"))

    def share(rank: str) -> Column:
        return F.coalesce(F.lit(1.0) / (F.lit(K.RRF_K) + F.col(rank)), F.lit(0.0))

    fused = left.join(right, ["query_id", item], "full").withColumn(
        "score", F.round(share("keyword_rank") + share("vector_rank"), 9)
    )
    best = W.partitionBy("query_id").orderBy(F.desc("score"), F.asc(item))
    return fused.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
