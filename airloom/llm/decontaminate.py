"""Benchmark decontamination by seeds that no accepted overlap can miss.

Tokens are the runs of letters and digits of the lower-cased text. Every item is cut into
tiles, runs of two to four tokens one after the other; a tile's seed is the hash of its
tokens. Documents are hashed at each place in each width that tiles have. A seed in common
names a document, an item and a diagonal (document place minus item place). Along each
diagonal all tokens of the item are then compared with the document's: an overlap counts if it
matches `share` of the item, or holds a stretch of score `stretch` (+1 for each equal token,
-2 for each other one), so substituted tokens are tolerated.

Whatever counts has a tile without a difference, so it is found:

* `share` of n tokens leaves m = n - ceil(share n) differences (places beyond the document's ends
  are differences too). There are at least m + 1 tiles, and a difference spoils one tile.
* A stretch with f differences has at least stretch + 3 f tokens. Of tiles of w tokens at most,
  it holds (stretch + 3 f - 2 (w - 1)) / w, rounded up, and w is chosen so that these are more
  than f for every f that the item's length admits: w <= (stretch + 3 f + 1) / (f + 2).

Short tiles also meet by chance, in proportion to the tokens of the documents times those of the
benchmark; such meetings cost a comparison each and are dropped by it. Items of fewer than
`LEAST` tokens are too common to tell anything and are left out.

Only DataFrame functions are used. Seeds are exploded and probed in one generated stage.
The benchmark's seeds are counted first and broadcast up to `BROADCAST_SEEDS`; beyond that the
same join shuffles both sides, whatever the optimizer takes the documents' seeds for. Only documents with a hit are read again, by id.

Defined results: null and empty texts have no token and match nothing; `overlaps` gives
rows that share an id (a null id too) one verdict, `keep_clean` judges every row by its own text; repeated rows and items change nothing; items without
id are not compared; further columns are ignored; with an empty table on either side
nothing is found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.functions.joins import never_broadcast
from airloom.llm.shared import row_identity, stored

LEAST = 5
SHARE, STRETCH, MISMATCH = 0.7, 13, -2
#: Tokens of a tile at most; fewer where the proof asks for it.
WIDEST = 4
#: Seeds (about 40 bytes each) that may be broadcast.
BROADCAST_SEEDS = 500_000


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), 0)


def _seed(at: Column, width: int) -> Column:
    """The hash of `width` tokens from the place `at`; null where the text ends before."""
    under = [F.try_element_at("tokens", at + j) for j in range(width)]
    return F.when(at + (width - 1) <= F.size("tokens"), F.xxhash64(F.lit(width), *under))


def seeds(words: DataFrame, widths: list[int]) -> DataFrame:
    """The columns of `words` but for `tokens`, and `place` and `seed` for every width and place."""
    keep = [c for c in words.columns if c != "tokens"]
    count = F.size("tokens")
    least = min(widths, default=1)
    # an outer explode, because the optimiser infers filters for an inner one and would then
    # split every text twice
    every = F.when(count >= least, F.sequence(F.lit(1), count - (least - 1)))
    placed = words.select(*keep, "tokens", F.explode_outer(every).alias("i"))
    each = F.array(*[_seed(F.col("i"), w) for w in widths], F.lit(None).cast("long"))
    made = placed.select(*keep, F.col("i").alias("place"), F.explode_outer(each).alias("seed"))
    return made.filter("seed IS NOT NULL")


def tiles(items: DataFrame, share: float = SHARE, stretch: int = STRETCH) -> DataFrame:
    """The columns of `items` (with `tokens`), and `place` and `width` of every tile of each."""
    n, loss = F.col("n"), 1 - MISMATCH
    cut = items.withColumn("n", F.size("tokens").cast("long"))
    cut = cut.withColumn("needed", F.greatest(n - F.ceil(F.lit(share) * n), F.lit(0)) + 1)  # tiles, for the share
    f = F.floor((n - stretch) / loss)
    by_stretch = [F.floor((stretch + loss * x + 1) / (x + 2)) for x in (F.lit(0), f)]
    cut = cut.withColumn("cap", F.when(n < stretch, WIDEST).otherwise(F.least(F.lit(WIDEST), *by_stretch)))
    grid = F.floor(n / F.col("needed")) >= F.col("cap")
    cut = cut.withColumns({
        "count": F.when(grid, F.floor(n / F.col("cap"))).otherwise(F.col("needed")),
        "base": F.when(grid, F.col("cap")).otherwise(F.floor(n / F.col("needed"))),
        "wider": F.when(grid, 0).otherwise(n % F.col("needed")),
    })
    cut = cut.withColumn("t", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)))
    place = F.col("t") * F.col("base") + F.least("t", "wider") + 1
    width = F.col("base") + (F.col("t") < F.col("wider")).cast("long")
    return cut.select(*items.columns, place.cast("int").alias("place"), width.cast("int").alias("width"))


def overlaps(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    item_text: str = "text", share: float = SHARE, stretch: int = STRETCH,
) -> DataFrame:
    """(key, item, matched, item_tokens) of every document and item that overlap.

    `matched` is the largest number of equal tokens on one diagonal that counts.
    """
    items = benchmark.filter(F.col(item).isNotNull()).select(F.col(item).alias("item"), tokens(F.col(item_text)).alias("tokens"))
    items = items.filter(F.size("tokens") >= LEAST).distinct()
    cut = tiles(items, share, stretch)
    seed = F.coalesce(*[F.when(F.col("width") == w, _seed(F.col("place"), w)) for w in range(1, WIDEST + 1)])
    theirs = stored(cut.select(seed.alias("seed"), "item", F.col("place").alias("item_place"), "width").distinct())
    used = sorted(r.width for r in theirs.select("width").distinct().collect())
    theirs = theirs.drop("width")
    theirs = F.broadcast(theirs) if theirs.count() <= BROADCAST_SEEDS else never_broadcast(theirs)
    words = docs.select(F.col(key).alias("key"), tokens(F.col(text)).alias("tokens"))
    hits = seeds(words, used).join(theirs, "seed")
    hits = stored(hits.select("key", "item", (F.col("place") - F.col("item_place")).alias("diagonal")).distinct())
    again = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    wanted = hits.select("key").distinct()
    again = again.join(wanted, F.col("k").eqNullSafe(F.col("key")), "left_semi").select("k", tokens(F.col("t")).alias("words"))
    pairs = hits.join(items, "item").join(again, F.col("key").eqNullSafe(F.col("k")))
    first = F.greatest(1 - F.col("diagonal"), F.lit(1))  # of the item, where both have tokens
    last = F.least(F.size("words") - F.col("diagonal"), F.size("tokens"))
    span = F.greatest(last - first + 1, F.lit(0))
    pairs = pairs.filter(span > 0)
    same = F.zip_with(
        F.slice("tokens", first, span), F.slice("words", first + F.col("diagonal"), span), lambda a, b: a == b
    )
    pairs = pairs.select("key", "item", F.size("tokens").alias("item_tokens"), same.alias("same"))
    start = F.struct(F.lit(0).alias("here"), F.lit(0).alias("best"), F.lit(0).alias("matched"))

    def step(state: Column, equal: Column) -> Column:
        here = F.greatest(state["here"] + F.when(equal, 1).otherwise(MISMATCH), F.lit(0))
        best = F.greatest(state["best"], here)
        return F.struct(here.alias("here"), best.alias("best"), (state["matched"] + equal.cast("int")).alias("matched"))

    scored = pairs.withColumn("s", F.aggregate("same", start, step))
    found = scored.filter((F.col("s.best") >= stretch) | (F.col("s.matched") >= share * F.col("item_tokens")))
    found = found.groupBy("key", "item").agg(F.max("s.matched").alias("matched"), F.max("item_tokens").alias("item_tokens"))
    return found.select(
        F.col("key").alias(key), F.col("item").alias(item), F.col("matched").cast("long"), F.col("item_tokens").cast("long")
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of `docs` that overlap with no item, each judged by its own text."""
    rows = docs.select(row_identity(key, text).alias("row"), F.col(text).alias("text"))
    leaked = stored(overlaps(rows, benchmark, "row", "text").select(F.col("row").alias("leaked_row")).distinct())
    return docs.join(leaked, row_identity(key, text) == F.col("leaked_row"), "left_anti")


#: Without seeds: every diagonal with as many equal tokens as either rule asks for, compared row by row.
ORACLE = r"""
WITH items AS (
  SELECT DISTINCT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark WHERE item_id IS NOT NULL
), docs AS (
  SELECT DISTINCT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents
), item_tokens AS (
  SELECT item_id, len(w) AS n, unnest(w) AS token, unnest(range(1, len(w) + 1)) AS i FROM items WHERE len(w) >= 5
), doc_tokens AS (
  SELECT doc_id, unnest(w) AS token, unnest(range(1, len(w) + 1)) AS i FROM docs
), hits AS (
  SELECT d.doc_id, t.item_id, d.i - t.i AS diagonal FROM doc_tokens d JOIN item_tokens t USING (token)
  GROUP BY ALL HAVING count(*) >= least(13, ceil(0.7 * any_value(t.n)))
), compared AS (
  SELECT h.doc_id, h.item_id, diagonal, len(items.w) AS n, unnest(range(1, len(items.w) + 1)) AS j, items.w AS iw, docs.w AS dw
  FROM hits h JOIN items USING (item_id) JOIN docs ON docs.doc_id IS NOT DISTINCT FROM h.doc_id
), scores AS (
  SELECT doc_id, item_id, diagonal, n, j, CASE WHEN iw[j] = dw[j + diagonal] THEN 1 ELSE -2 END AS s
  FROM compared WHERE j + diagonal BETWEEN 1 AND len(dw)
), sums AS (
  SELECT *, sum(s) OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY j) AS c FROM scores
), stretches AS (
  SELECT *, c - least(0, coalesce(min(c) OVER (PARTITION BY doc_id, item_id, diagonal ORDER BY j
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS stretch FROM sums
), judged AS (
  SELECT doc_id, item_id, diagonal, n, count(*) FILTER (s = 1) AS matched, max(stretch) AS best
  FROM stretches GROUP BY doc_id, item_id, diagonal, n
)
SELECT doc_id, item_id, max(matched) AS matched, max(n) AS item_tokens
FROM judged WHERE best >= 13 OR matched >= 0.7 * n GROUP BY doc_id, item_id
"""
