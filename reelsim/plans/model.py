"""The recommender: fit once, answer batches of queries.

Every query method takes a *query table* (one row per request) and
returns one DataFrame for the whole batch; single-request helpers build a
one-row query table.  Nothing is collected to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelsim.functions.genres import ALL_GENRES, genre_filter_key, genre_matches, pattern_valid
from reelsim.functions.text import clean_tokens, raw_tokens
from reelsim.functions.titles import normalise_query
from reelsim.operators import browse, impact, lookup, tfidf, tiles
from reelsim.operators.similarity import BROADCAST_QUERY_ROWS, SCORE_DECIMALS, maybe_broadcast, rank_with_padding
from reelsim.plans.prepare import TextParams, lineage, prepare_catalog
from reelsim.session import bounded_tasks

OUTPUT_COLUMNS = ("title", "description", "ratings", "genre", "expanded_genres")
QID = "query_id"


@dataclass
class ModelParams:
    text: TextParams = field(default_factory=TextParams)
    min_df: int = tfidf.MIN_DF
    max_features: int | None = tfidf.MAX_FEATURES
    sublinear_tf: bool = True
    tokenizer: str = "clean"          # "clean" (X1) or "raw" (V3b: refit on raw text)
    num_partitions: int | None = None


class Recommender:
    """Catalogue + TF-IDF model + title index."""

    def __init__(self, catalog: DataFrame, model: tfidf.TfidfModel, params: ModelParams):
        self.catalog = catalog
        self.model = model
        self.params = params
        self.titles = catalog.select("row_id", "title", "title_key", "name_only")
        self._index: DataFrame | None = None
        self._freq: DataFrame | None = None
        self._tiles: tuple[DataFrame, DataFrame, DataFrame] | None = None
        self._sizes: dict | None = None
        self._heads: tuple[int, DataFrame] | None = None
        self._prepared: dict | None = None
        self._unstored: DataFrame | None = None
        self._stored = False
        self._kept: list[DataFrame] = []
        self._requests: list[DataFrame] = []

    @property
    def index(self) -> DataFrame:
        """Title n-gram index, built on first use (stored when the model is)."""
        if self._index is None:
            idx = lookup.gram_index(self.titles)
            if self._stored:
                from reelsim.session import store_table
                idx = store_table(idx, "title_grams")
            self._index = idx
        return self._index

    @property
    def freq(self) -> DataFrame:
        """Rows per gram of the title index."""
        if self._freq is None:
            fr = lookup.gram_frequency(self.index)
            if self._stored:
                from reelsim.session import store_table
                fr = store_table(fr, "gram_freq")
            self._freq = fr
        return self._freq

    def heads(self, limit: int) -> DataFrame:
        """First titles of every short substring, built on first use for
        lists of ``limit`` rows or fewer."""
        if self._heads is None or self._heads[0] < limit:
            rows = max(limit, lookup.HEAD_ROWS)
            made = lookup.gram_heads(self.titles, rows)
            if self._stored:
                from reelsim.session import store_table
                made = store_table(made, "title_heads")
            self._heads = rows, made
        return self._heads[1]

    @property
    def by_document(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """``(term ids, genre ids, vectors)``: the model by document, built
        on first use (stored when the model is)."""
        if self._tiles is None:
            ids, genres = tiles.term_ids(self.model.vocabulary), tiles.genre_ids(self.catalog)
            make = tiles.store_vectors if self._stored else tiles.document_vectors
            self._tiles = ids, genres, make(self.model.postings, self.catalog, ids, genres)
        return self._tiles

    @property
    def blocks(self) -> DataFrame:
        """Postings with the band and level of their block (stored on first
        use when the model is: only searches for one request read them so)."""
        if "level" in self.model.postings.columns:
            return self.model.postings
        made = self._unstored if self._unstored is not None else impact.with_blocks(self.model.postings, self.model.vocabulary)
        if self._stored:
            from reelsim.session import store_table
            with bounded_tasks(made.sparkSession):
                made = self.model.postings = store_table(made, "postings", ("band", "level"))
            self._unstored = None
        return made

    @property
    def block_sizes(self) -> dict:
        """Rows and greatest weight per block, counted on first use."""
        if self._sizes is None:
            self._sizes = impact.block_sizes(self.blocks)
        return self._sizes

    def _keep(self, df: DataFrame, bounded: bool | None = True) -> DataFrame:
        """Compute a per-request table once: cached in memory until
        :meth:`release` when the batch is known to be small, otherwise
        written as a Parquet table in the shared checkpoint folder."""
        from reelsim.session import cache_small, store_table
        if not bounded:
            df = store_table(df, "request")
            self._requests.append(df)
            return df
        df = cache_small(df)
        self._kept.append(df)
        return df

    def release(self) -> None:
        """Drop the per-request caches and stored request tables (call when
        the answers are written: they can't be read again afterwards)."""
        from reelsim.session import drop_table
        while self._kept:
            self._kept.pop().unpersist()
        while self._requests:
            drop_table(self._requests.pop())

    # ---- fitting -------------------------------------------------------
    @classmethod
    def fit(cls, films: DataFrame, params: ModelParams | None = None,
            dedupe: bool = True, materialize: bool = False) -> "Recommender":
        """Prepare the catalogue and fit TF-IDF (V3).  ``dedupe=False`` is
        the notebook catalogue (cleaning only).

        ``materialize=True`` stores the catalogue first (reliable
        checkpoint) and fits from the stored table, then stores the model
        tables and title index: the text pipeline runs once.
        """
        params = params or ModelParams()
        if materialize:
            with bounded_tasks(films.sparkSession):
                return cls._fit_stored(films, params, dedupe)
        catalog = prepare_catalog(films, params.text, dedupe=dedupe)
        src, to_terms = cls._tokens(params)
        model = tfidf.fit(catalog.select("row_id", src.alias("tokens")), "tokens", params.min_df, params.max_features,
                          params.sublinear_tf, num_partitions=params.num_partitions, to_terms=to_terms)
        return cls(catalog, model, params)

    @staticmethod
    def _tokens(params: ModelParams):
        """The column to fit on, and what makes terms of it after the
        repartition (ship tokens, not the larger n-gram arrays)."""
        if params.tokenizer == "raw":
            return F.col("description"), lambda c: tfidf.uni_bi_grams(raw_tokens(c))
        return F.col("tokens"), tfidf.uni_bi_grams

    @classmethod
    def _fit_stored(cls, films: DataFrame, params: ModelParams, dedupe: bool) -> "Recommender":
        from reelsim.session import drop_table, store_table
        seen = Observation("prepared")
        catalog = prepare_catalog(films, params.text, dedupe=dedupe, seen=seen)
        # the joined text is derived from the tokens on read, not stored twice
        catalog = store_table(catalog.drop("clean_description"), "catalog")
        catalog = catalog.withColumn("clean_description", F.array_join("tokens", " "))
        n_docs = F.lit(catalog.count()).cast("long")
        raw = params.tokenizer == "raw" and bool(params.max_features)
        # the raw text is split once for all passes over it; its tokens hold no
        # blank, and one string is stored and sent sooner than a list
        docs = (store_table(catalog.select("row_id", "genre_src", F.array_join(raw_tokens("description"), " ").alias("tokens")), "raw_tokens") if raw
                else catalog.select("row_id", "genre_src", "tokens"))
        if params.max_features:
            model = tfidf.fit_rows(docs, params.min_df, params.max_features, params.sublinear_tf, n_docs=n_docs)
        else:
            src, to_terms = cls._tokens(params)
            model = tfidf.fit(catalog.select("row_id", src.alias("tokens")), "tokens", params.min_df, None, params.sublinear_tf,
                              num_partitions=params.num_partitions, to_terms=to_terms, n_docs=n_docs)
        rec = cls(catalog, model, params)
        rec._prepared = seen.get
        rec._store_model(docs)
        if raw:
            drop_table(docs)
        return rec

    def lineage(self, films: DataFrame) -> DataFrame:
        """Rows per preparation step (A19) of a model fitted on ``films``
        with ``materialize=True``."""
        if self._prepared is None:
            raise ValueError("the steps are counted while a fit is stored: fit with materialize=True")
        return lineage(films, self._prepared["deduped"], self._prepared["kept"] or 0)

    def persist(self) -> "Recommender":
        """Keep the model tables in executor memory (spilling to disk);
        lost blocks are recomputed from lineage."""
        self.catalog = self.catalog.drop("tokens").persist()
        self.model.persist()
        self.titles = self.catalog.select("row_id", "title", "title_key", "name_only")
        self._index = lookup.gram_index(self.titles).persist()
        self._freq = lookup.gram_frequency(self._index).persist()
        return self

    def materialize(self) -> "Recommender":
        """Cut lineage: write catalogue, model tables and title index as
        Parquet tables in the shared checkpoint folder (they survive
        executor loss, unlike a local checkpoint), so every later query
        starts from stored, column-pruned tables instead of re-running the
        fit."""
        from reelsim.session import store_table
        self.catalog = store_table(self.catalog, "catalog")
        return self._store_model()

    def _store_model(self, docs: DataFrame | None = None) -> "Recommender":
        from reelsim.session import store_table
        self.model.vocabulary = store_table(self.model.vocabulary, "vocabulary")
        if self.model.vocabulary.isEmpty():
            raise ValueError(f"no term occurs in {self.params.min_df} or more descriptions: nothing to fit")
        self._index = self._freq = self._tiles = self._sizes = self._heads = self._unstored = None
        self._stored = True
        if self.model.by_row:
            self._unstored = self._weigh_rows(docs)
            self.model.postings = self._unstored.drop("band", "level")
        elif self.model.weigh:
            # weighed by the stored vocabulary: its terms alone are counted again
            self.model.postings = self.model.weigh(self.model.vocabulary)
        if self._tiles is None:
            # else postings are read from the stored vectors
            _ = self.blocks
        self.model.weigh = self.model.by_row = None
        self.model.n_docs = F.lit(self.catalog.count()).cast("long")
        self.titles = self.catalog.select("row_id", "title", "title_key", "name_only")
        _ = self.by_document
        return self

    def _weigh_rows(self, docs: DataFrame) -> DataFrame:
        """Postings of ``docs(row_id, genre_src, tokens)`` with their blocks,
        weighed row by row and stored by document; rows that share an id are
        added from counts."""
        vocabulary = self.model.vocabulary
        ids, genres = tiles.term_ids(vocabulary), tiles.genre_ids(self.catalog)
        # at most max_features rows
        terms = [tuple(r) for r in ids.join(vocabulary.select("term", "idf"), "term").select("term", "term_id", "idf").collect()]
        rows = docs.join(maybe_broadcast(genres), "genre_src", "left")
        made = tiles.store_sorted(self.model.by_row(rows, terms), self.catalog)
        found = made.select("row_id", F.inline(F.arrays_zip("ids", "tfs", "ws")))
        named = F.broadcast(ids.select("term", "term_id", impact.band_of(F.col("df")).alias("band")))
        found = found.join(named, F.col("ids") == F.col("term_id")).select(
            "row_id", "term", F.col("tfs").alias("tf"), F.col("ws").alias("w"), "band", impact.level_of(F.col("ws")).alias("level"))
        if self.model.weigh:
            return found.unionByName(impact.with_blocks(self.model.weigh(vocabulary), vocabulary))
        self._tiles = ids, genres, made
        return found

    def save(self, path: str) -> str:
        """Write the model tables as Parquet."""
        from reelsim.sources import store
        return store.save_model(self, path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Recommender":
        """Read a saved model."""
        from reelsim.sources import store
        return store.load_model(spark, path)

    # ---- query helpers -------------------------------------------------
    def _query_terms(self, queries: DataFrame, text_col: str) -> DataFrame:
        if self.params.tokenizer == "raw":
            toks = raw_tokens(F.col(text_col))
        else:
            t = self.params.text
            toks = clean_tokens(F.col(text_col), stop_words=t.stop_words,
                                min_len=t.min_len, lexicon=t.lexicon)
        return queries.withColumn("_toks", toks)

    def _results(self, ranked: DataFrame, score_col: str = "similarity_score",
                 bounded: bool | None = None, catalog: DataFrame | None = None) -> DataFrame:
        cat = (self.catalog if catalog is None else catalog).select("row_id", *OUTPUT_COLUMNS)
        # ranked holds n rows per query: the small side
        out = cat.join(F.broadcast(ranked) if bounded else ranked, "row_id")
        return out.select(QID, "rank", "row_id", *OUTPUT_COLUMNS,
                          F.round("score", SCORE_DECIMALS).alias(score_col))

    def resolve(self, queries: DataFrame, text_col: str = "text",
                bounded: bool | None = None) -> DataFrame:
        """``(query_id, row_id, tier, matched_key)``."""
        return lookup.resolve_titles(queries, self.titles, lambda: self.index, lambda: self.freq,
                                     QID, text_col, bounded,
                                     keep=lambda df: self._keep(df, bounded))

    def vectors_of_rows(self, rows: DataFrame, bounded: bool | None = None,
                        keep_self: bool = False) -> DataFrame:
        """Model vectors of catalogue rows as query vectors:
        ``rows(query_id, row_id)`` -> ``(query_id, term, w[, _self])``."""
        r = maybe_broadcast(rows.select(QID, "row_id"), bounded)
        extra = [F.col("row_id").alias("_self")] if keep_self else []
        return self.model.postings.join(r, "row_id").select(QID, "term", "w", *extra)

    # ---- the query API -------------------------------------------------
    def by_title(self, queries: DataFrame, n: int = 5, text_col: str = "text",
                 filter_col: str | None = None, bounded: bool | None = None) -> DataFrame:
        """Most similar rows to a title (V6): resolve, score against every
        document that the optional genre regex lets through, leave the movie
        itself out, top n.  Unknown titles give no rows."""
        # one small row per query, read several ways below (exclusion,
        # filter, padding, query vectors): compute it once
        res = self._keep(self.resolve(queries, text_col, bounded), bounded)
        q = res.select(QID, F.col("row_id").alias("_self"), F.lit(None).cast("string").alias("_gf"))
        if filter_col:
            q = q.drop("_gf").join(queries.select(QID, genre_filter_key(F.col(filter_col)).alias("_gf")), QID)
        vectors = self.by_document[2].select(F.col("row_id").alias("_self"), "ids", "ws")
        scored = self._scored(q.join(vectors, "_self"), n)
        ranked = rank_with_padding(scored, q, self.catalog, n, QID, exclude_col="_self",
                                   filter_col="_gf" if filter_col else None, bounded=bounded, filtered=True)
        return self._results(ranked, bounded=bounded or self._few(res, n))

    @staticmethod
    def _few(queries: DataFrame, n: int) -> bool:
        """Whether the answers to a stored request table may be broadcast;
        else the catalogue's texts are shuffled to them."""
        return queries.count() * n <= BROADCAST_QUERY_ROWS

    def _scored(self, vectors: DataFrame, n: int) -> DataFrame:
        """Top ``n`` scored rows per query vector, tile by tile."""
        _, genres, docs = self.by_document
        scored = tiles.tile_top_n(vectors, docs, genres, n, QID)
        self._requests.append(scored)
        return scored

    def by_description(self, queries: DataFrame, n: int = 5, text_col: str = "text",
                       filter_col: str | None = None, bounded: bool | None = None,
                       skip_empty: bool = True) -> DataFrame:
        """Best matches for free text (V7): clean like the catalogue, keep
        vocabulary terms, weigh, score, optional genre regex, top n.  A
        query that cleans to nothing gives no rows (F9); one with only
        unknown words gives n rows of score 0."""
        # clean once per request row and keep the result: otherwise the
        # size filters below are pushed under the caller's joins and the
        # cleaning runs over whatever table the requests were taken from
        q = self._keep(self._query_terms(queries, text_col), bounded)
        if skip_empty:
            q = q.filter(F.size("_toks") > 0)
        docs = q.select(QID, tfidf.uni_bi_grams(F.col("_toks")).alias("terms"))
        qv = tfidf.transform(self.model, docs, "terms", QID)
        gf = genre_filter_key(F.col(filter_col)) if filter_col else F.lit(None).cast("string")
        qq = q.select(QID, gf.alias("_gf"))
        vectors = tiles.as_vectors(qv, self.by_document[0], QID).join(qq, QID)
        scored = self._scored(vectors.withColumn("_self", F.lit(None).cast("long")), n)
        ranked = rank_with_padding(scored, qq, self.catalog, n, QID,
                                   filter_col="_gf" if filter_col else None, bounded=bounded, filtered=True)
        return self._results(ranked, bounded=bounded or self._few(q, n))

    def by_genre(self, queries: DataFrame, n: int = 5, genre_col: str = "genre") -> DataFrame:
        """Top-rated rows of a genre (V8); no similarity column."""
        r = browse.by_genre(self.catalog.select("row_id", *OUTPUT_COLUMNS, "genre_src"),
                            queries, n, QID, genre_col, titles_unique=True)
        return r.select(QID, "rank", "row_id", *OUTPUT_COLUMNS)

    def suggest(self, queries: DataFrame, limit: int = 8, text_col: str = "text",
                min_chars: int = 0, bounded: bool | None = None) -> DataFrame:
        """Title suggestions."""
        return lookup.suggest_titles(queries, self.titles, lambda: self.index, lambda: self.freq, self.heads, limit,
                                     QID, text_col, min_chars, bounded)

    def rejected(self, queries: DataFrame, filter_col: str) -> DataFrame:
        """``(query_id, pattern)`` of the requests whose genre filter is no
        regex.  They get no rows; the rest of their batch is answered."""
        ok = pattern_valid(genre_filter_key(F.col(filter_col)))
        return (queries.select(QID, F.col(filter_col).alias("pattern"), ok.alias("_ok"))
                       .filter(~F.col("_ok")).select(QID, "pattern"))

    def all_genres(self) -> DataFrame:
        """Distinct genres (V9); order by ``genre``."""
        return browse.all_genres(self.catalog)

    def stats(self) -> DataFrame:
        """total_movies, tfidf_features, total_genres, sparsity_pct."""
        def n(df: DataFrame):
            return df.select(F.count(F.lit(1))).scalar()

        rows, feats, nnz = n(self.catalog), n(self.model.vocabulary), n(self.model.postings)
        genres = n(self.all_genres())
        shell = self.catalog.sparkSession.range(1).select()
        return shell.select(
            rows.alias("total_movies"), feats.alias("tfidf_features"), genres.alias("total_genres"),
            F.round(tfidf.sparsity_pct(rows, feats, nnz), 1).alias("sparsity_pct"))

    # ---- one-request helpers ------------------------------------------
    def _one(self, **cols) -> DataFrame:
        spark = self.catalog.sparkSession
        fields = [T.StructField(QID, T.LongType())] + [T.StructField(k, T.StringType()) for k in cols]
        return spark.createDataFrame([(0, *cols.values())], T.StructType(fields))

    def _search(self, vector: DataFrame, genre_filter: str | None, n: int, own: int | None = None) -> DataFrame:
        """One request over ``vector(term, df, w)``, reading only the blocks
        that can matter (``operators.impact``); the list is filled up with
        the highest rows of score 0, as in a batch."""
        # one request's terms: at most the vocabulary
        terms = vector.select("term", impact.band_of(F.col("df")).alias("band"), "w").collect()
        ids, genres, vectors = self.by_document
        allowed = None
        if genre_filter not in (None, "", ALL_GENRES):
            # the pattern is tested on the distinct genre strings
            pattern = self._one(p=genre_filter).select(genre_filter_key("p").alias("p")).filter(pattern_valid("p"))
            met = genres.join(F.broadcast(pattern), genre_matches(F.col("genre_src"), F.col("p"))).select("genre_id")
            allowed = vectors.select("row_id", "genre_id").join(met, "genre_id", "left_semi").select("row_id")
        found = impact.search(impact.Request(tuple(map(tuple, terms))), self.blocks, self.block_sizes, vectors, ids, n, own, allowed)
        if len(found) < n:
            rows = allowed if allowed is not None else self.catalog.select("row_id")
            met = {row for row, _ in found} | {own}
            fill = [r["row_id"] for r in rows.orderBy(F.desc("row_id")).limit(n + 1).collect() if r["row_id"] not in met]
            found += [(row, 0.0) for row in fill[:n - len(found)]]
        ranked = self.catalog.sparkSession.createDataFrame([(0, i, row, score) for i, (row, score) in enumerate(found, 1)],
                                                           f"{QID} long, rank int, row_id long, score double")
        some = self.catalog.filter(F.col("row_id").isin([row for row, _ in found]))
        return self._results(ranked, bounded=True, catalog=some).orderBy("rank")

    def _resolve_one(self, title: str) -> int | None:
        """The row of one title: an exact key or name by a filter that
        reaches the scan, else by the tiers."""
        key = normalise_query(F.lit(title))
        exact = self.titles.filter((key != "") & ((F.col("title_key") == key) | (F.col("name_only") == key)))
        tier = F.when(F.col("title_key") == key, 1).otherwise(2)
        row = exact.agg(F.min(F.struct(tier.alias("tier"), "row_id")).alias("b")).first()["b"]
        row = row or self.resolve(self._one(text=title), bounded=True).select("row_id").first()
        return row["row_id"] if row else None

    def recommend_by_title(self, title: str, genre_filter: str | None = None, n: int = 5) -> DataFrame:
        """One title (V6), by the pruned search.  Lists longer than that
        holds, and unknown titles, are a batch of one."""
        row = self._resolve_one(title) if n <= impact.HELD else None
        if row is None:
            return self.by_title(self._one(text=title, gf=genre_filter), n, filter_col="gf", bounded=True).orderBy("rank")
        ids, _, vectors = self.by_document
        own = vectors.filter(F.col("row_id") == row).select(F.explode(F.arrays_zip("ids", "ws")).alias("v"))
        own = own.select(F.col("v.ids").alias("term_id"), F.col("v.ws").alias("w")).join(ids, "term_id")
        return self._search(own, genre_filter, n, row)

    def recommend_by_description(self, text: str, genre_filter: str | None = None, n: int = 5) -> DataFrame:
        """One free text (V7), by the pruned search; blank text gives no rows."""
        q = self._query_terms(self._one(text=text, gf=genre_filter), "text").filter(F.size("_toks") > 0)
        if n > impact.HELD or q.isEmpty():
            return self.by_description(self._one(text=text, gf=genre_filter), n, filter_col="gf", bounded=True).orderBy("rank")
        docs = q.select(QID, tfidf.uni_bi_grams(F.col("_toks")).alias("terms"))
        vector = tfidf.transform(self.model, docs, "terms", QID).join(self.model.vocabulary.select("term", "df"), "term")
        return self._search(vector, genre_filter, n)

    def recommend_by_genre(self, genre: str, n: int = 5) -> DataFrame:
        return self.by_genre(self._one(genre=genre), n).orderBy("rank")

    def title_suggestions(self, query: str, limit: int = 8) -> DataFrame:
        return self.suggest(self._one(text=query), limit, bounded=True).orderBy("rank")

