"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic. The weight of a cell, the mean number of times its documents
are drawn, is raked in turn until the drawn tokens meet the target shares of the sources and, as near as the caps allow,
the marginal shares of languages and topics; no weight rises above its source's cap, and the source margin is closed
last, so it holds exactly. Unless a total is given it is the largest at which every source with documents can reach
its share. A source without documents reaches nothing; its share falls to the others in proportion.

Documents are then drawn by their calibrated weight w, floor(w) or ceil(w) times, by systematic sampling: along a fixed
order of all documents of a source (by size class, hash and size) the expected copies are summed up, and a document is drawn
as often as an integer is passed. The sum runs over chunks of a bounded number of rows, then over spans of a bounded number of
chunks, then over the spans of a size class, so no source is gathered in one task, and each source's drawn tokens differ from its target by about one document.

Nulls: a document without source, or of one that has no target, is not drawn; a missing language is one of its own.
Documents without tokens weigh nothing and are not drawn. Repeated ids are documents of their own. Empty tables give none.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weft.llm.tokens import DEFAULT, encoding
from weft.session import cut

# fixed values: three-letter codes and the two-letter ones they stand for
LANGUAGES = {"eng": "en", "amh": "am", "orm": "om", "tha": "th", "ara": "ar", "fra": "fr", "fre": "fr", "zho": "zh", "chi": "zh"}
DIMS, ONE, BLOCK = 512, 1 << 22, 2048


def language(c: Column) -> Column:
    """The language as a two-letter code, und where none is given or it is no code; so there are few."""
    s = F.lower(F.trim(F.split(F.coalesce(c, F.lit("")), "[-_]")[0]))
    codes = F.create_map(*[F.lit(x) for kv in LANGUAGES.items() for x in kv])
    return F.when(s.rlike("^[a-z]{2,3}$"), F.coalesce(F.try_element_at(codes, s), s)).otherwise("und")


# -- topics -----------------------------------------------------------------------------------------------------------


def _packed(texts: list[str | None]) -> list[bytes]:
    """Each text's hashed words as a vector of length 1: whole numbers of value and place in one, ONE being 1."""
    counts = [Counter(t.lower().split()) if t else {} for t in texts]
    sizes = np.fromiter(map(len, counts), np.int64, len(counts))
    codes = np.fromiter((zlib.crc32(w.encode()) for c in counts for w in c), np.int64, int(sizes.sum())) % DIMS
    times = np.fromiter((k for c in counts for k in c.values()), np.float64, int(sizes.sum()))
    x = np.bincount(np.repeat(np.arange(len(counts)) * DIMS, sizes) + codes, 1 + np.log(times), minlength=len(counts) * DIMS).reshape(-1, DIMS)
    x /= np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-9)
    x = np.rint(x * ONE).astype(np.uint32)
    row, place = np.nonzero(x)
    flat, ends = (x[row, place] * DIMS + place).astype("<u4"), np.searchsorted(row, np.arange(len(counts) + 1))
    return [flat[i:j].tobytes() for i, j in zip(ends, ends[1:])]


def _nearest(words: list[bytes], centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each text's nearest centre; row, place and value of all numbers. Products of whole numbers under 2 ** 53, so exact
    in whatever order they are summed."""
    flat = np.frombuffer(b"".join(words), "<u4").astype(np.int64)
    row, place, value = np.repeat(np.arange(len(words)), [len(w) // 4 for w in words]), flat % DIMS, (flat // DIMS).astype(float)
    x = np.zeros((len(words), DIMS))
    x[row, place] = value
    return (x @ centres.T).argmax(axis=1), row, place, value


def _blocks(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in it:
        for at in range(0, len(pdf), BLOCK):
            yield pdf.iloc[at : at + BLOCK]


def _unit(sums: np.ndarray) -> np.ndarray:
    return np.rint(sums / np.maximum(np.sqrt((sums * sums).sum(axis=1, keepdims=True)), 1e-9) * ONE)


def fit_topics(docs: DataFrame, topics: int, *, rounds: int = 15) -> np.ndarray:
    """Centres of spherical k-means over the `words` (_packed) of all documents. It starts from the different vectors of the
    smallest hashes; each round sums all documents by their nearest centre, and the rounds end when no centre moves."""
    rows = docs.where("length(words) > 0").select("words", F.xxhash64("words", F.lit(7)).alias("hash"))

    def smallest(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = pd.DataFrame({"words": [], "hash": []})
        for pdf in it:
            best = pd.concat([best, pdf]).drop_duplicates().sort_values(["hash", "words"]).head(topics)
        yield best

    first = rows.mapInPandas(smallest, rows.schema).distinct().orderBy("hash", "words").limit(topics).collect()
    if not first:
        return np.zeros((1, DIMS))
    centres = np.zeros((len(first), DIMS))
    for k, r in enumerate(first):
        flat = np.frombuffer(r["words"], "<u4").astype(np.int64)
        centres[k, flat % DIMS] = flat // DIMS
    for _ in range(rounds):

        def summed(it: Iterator[pd.DataFrame], centres: np.ndarray = centres) -> Iterator[pd.DataFrame]:
            total = np.zeros(centres.size)
            for pdf in _blocks(it):
                own, row, place, value = _nearest(pdf["words"].tolist(), centres)
                total += np.bincount(own[row] * DIMS + place, value, minlength=centres.size)
            at = np.flatnonzero(total)
            yield pd.DataFrame({"at": at.astype("int32"), "s": total[at].astype("int64")})

        # no more rows than numbers in the centres
        got = rows.select("words").mapInPandas(summed, "at int, s bigint").groupBy("at").agg(F.sum("s").alias("s")).collect()
        sums = np.zeros(centres.size)
        sums[[r["at"] for r in got]] = [r["s"] for r in got]
        sums = sums.reshape(centres.shape)
        last, centres = centres, np.where(sums.any(axis=1, keepdims=True), _unit(sums), centres)
        if (last == centres).all():
            break
    return centres


def measured(docs: DataFrame, topics: int = 8, *, path: str = DEFAULT) -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens): whole texts, read once."""
    kind = dict(docs.dtypes)["doc_id"]

    def read(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoding(path)
        for pdf in _blocks(it):
            n = [len(enc.encode_ordinary(t)) if t else 0 for t in pdf["text"]]
            yield pdf[["doc_id", "source", "lang"]].assign(n_tokens=np.array(n, dtype="int64"), words=_packed(pdf["text"].tolist()))

    seen = docs.select("doc_id", "source", language(F.col("lang")).alias("lang"), "text").mapInPandas(read, f"doc_id {kind}, source string, lang string, n_tokens bigint, words binary")
    seen = cut(seen, "words")
    centres = fit_topics(seen, topics)

    def assign(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _blocks(it):
            yield pdf[["doc_id", "source", "lang"]].assign(topic=_nearest(pdf["words"].tolist(), centres)[0].astype("int32"), n_tokens=pdf["n_tokens"])

    return seen.mapInPandas(assign, f"doc_id {kind}, source string, lang string, topic int, n_tokens bigint")


# -- raking -----------------------------------------------------------------------------------------------------------


def rake(tokens: np.ndarray, dims: list[np.ndarray], shares: list[np.ndarray], caps: np.ndarray, total: float, *, rounds: int = 200, close: float = 1e-9) -> np.ndarray:
    """Weights of cells so that each dimension's drawn tokens have its shares of the total; dims[0] holds exactly, the
    others as far as the caps (of dims[0]) let them. dims: each cell's category; shares: of each category."""
    w = np.minimum(np.ones(len(tokens)), caps[dims[0]])
    for _ in range(rounds):
        before = w
        for d, share in zip(dims[1:] + dims[:1], shares[1:] + shares[:1]):
            got = np.bincount(d, w * tokens, minlength=len(share))
            f = np.divide(share * total, got, out=np.ones_like(got), where=got > 0)
            w = np.minimum(w * f[d], caps[dims[0]])
        if np.abs(w - before).max(initial=0) < close:
            break
    # the first margin is closed where caps cut it: what is missing goes to the cells with room left
    for _ in range(rounds):
        got = np.bincount(dims[0], w * tokens, minlength=len(shares[0]))
        lack = shares[0] * total - got
        room = np.bincount(dims[0], (caps[dims[0]] - w) * tokens, minlength=len(shares[0]))
        if np.all(np.abs(lack) <= 1e-6 * np.maximum(1, shares[0] * total)) or not np.any((lack > 0) & (room > 0) | (lack < 0)):
            break
        up = np.clip(np.divide(lack, room, out=np.zeros_like(lack), where=room > 0), 0, 1)
        down = np.clip(np.divide(shares[0] * total, got, out=np.ones_like(got), where=got > 0), 0, 1)
        w = np.where(lack[dims[0]] >= 0, w + up[dims[0]] * (caps[dims[0]] - w), w * down[dims[0]])
    return np.minimum(w, caps[dims[0]])


def calibrate(docs: DataFrame, target: DataFrame, *, total: float | None = None) -> pd.DataFrame:
    """Weight of every cell of source, language and topic. The cells, their number bounded by the three lists, and the
    targets come to the driver; documents don't."""
    cells = docs.where("n_tokens > 0").join(F.broadcast(target.select("source")), "source", "left_semi").groupBy("source", "lang", "topic").agg(F.sum("n_tokens").alias("tokens")).orderBy("source", "lang", "topic").toPandas()
    if not len(cells):
        return cells.assign(weight=pd.Series(dtype=float))
    goal = target.groupBy("source").agg(F.max("target_share").alias("share"), F.max("max_repeats").alias("cap")).toPandas().set_index("source")
    src, names = pd.factorize(cells["source"])
    share = goal["share"].reindex(names).fillna(0).to_numpy(float)
    share = share / (share.sum() or 1.0)
    cap = goal["cap"].reindex(names).fillna(0).to_numpy(float)
    t = cells["tokens"].to_numpy(float)
    held = np.bincount(src, t, minlength=len(names))
    most = min((cap[i] * held[i] / share[i] for i in range(len(names)) if share[i] > 0), default=0.0)
    total = most if total is None else min(total, most)
    dims, shares = [src], [share]
    for c in ("lang", "topic"):
        d, u = pd.factorize(cells[c])
        dims.append(d)
        shares.append(np.bincount(d, t, minlength=len(u)) / t.sum())
    return cells.assign(weight=rake(t, dims, shares, cap, total))


# -- drawing ----------------------------------------------------------------------------------------------------------


def draw(docs: DataFrame, weights: DataFrame, *, rows: int, chunk_rows: int = 4096) -> DataFrame:
    """(doc_id, source, n_tokens, copies) of the documents drawn at least once. rows: about how many documents there are."""
    prefixes = max(1, -(-rows // chunk_rows))
    # cells number no more than sources x languages x topics
    d = docs.where("n_tokens > 0").join(F.broadcast(weights.select("source", "lang", "topic", "weight")), ["source", "lang", "topic"])
    d = d.withColumn("size_class", F.floor(F.log2("n_tokens") * 2).cast("int")).withColumn("h", F.xxhash64("doc_id", F.lit(11)))
    d = d.withColumn("chunk", F.pmod("h", F.lit(prefixes))).withColumn("span", F.floor(F.col("chunk") / F.lit(chunk_rows)))
    along = ["size_class", "span", "chunk"]
    sums = d.groupBy("source", *along).agg(F.sum(F.col("weight").cast("decimal(28,12)")).alias("s"))
    # what lies before a chunk: the classes before its own, the spans before its own, the chunks before it in its span
    upto = [sums]
    for k in (2, 1):
        upto.append(upto[-1].groupBy("source", *along[:k]).agg(F.sum("s").cast("decimal(28,12)").alias("s")))
    for k, level in zip((3, 2, 1), upto):
        before = F.coalesce(F.sum("s").over(Window.partitionBy("source", *along[: k - 1]).orderBy(along[k - 1]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        part = level.select("source", *along[:k], before.cast("decimal(28,12)").alias(f"before{k}"))
        sums = sums.join(part, ["source", *along[:k]])
    sums = sums.select("source", *along, (F.col("before1") + F.col("before2") + F.col("before3")).cast("decimal(28,12)").alias("before"))
    inside = F.sum(F.col("weight").cast("decimal(28,12)")).over(Window.partitionBy("source", *along).orderBy("n_tokens", "h", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    d = d.withColumn("upto", inside).join(sums, ["source", *along])
    upto = F.col("before") + F.col("upto")
    start = F.lit("0.5").cast("decimal(28,12)")
    copies = F.floor(upto + start) - F.floor(upto - F.col("weight").cast("decimal(28,12)") + start)
    return d.select("doc_id", "source", "lang", "topic", "n_tokens", copies.cast("int").alias("copies")).where("copies > 0")


def margins_reached(sized: DataFrame, drawn: DataFrame, margin: str) -> DataFrame:
    """Per language or topic: its share of the tokens of all documents that could be drawn, and of those drawn."""
    had = sized.groupBy(margin).agg(F.sum("n_tokens").alias("had"))
    got = drawn.groupBy(margin).agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("got"))
    both = had.join(got, margin, "left").withColumn("got", F.coalesce("got", F.lit(0)))
    total = both.agg(F.sum("had").alias("all_had"), F.sum("got").alias("all_got"))
    share = lambda a, b: F.round(F.try_divide(F.col(a), F.col(b)), 6)
    return both.crossJoin(F.broadcast(total)).select(F.lit(margin).alias("margin"), F.col(margin).cast("string").alias("value"), share("had", "all_had").alias("target_share"), share("got", "all_got").alias("share_reached"))


def shares_reached(drawn: DataFrame, target: DataFrame) -> DataFrame:
    """Per source of the target: its share, tokens and documents drawn, the share reached, the most copies of one document."""
    got = drawn.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("tokens"), F.count("*").alias("documents"), F.max("copies").alias("most_copies"))
    total = got.agg(F.sum("tokens").alias("total"))
    return target.join(got, "source", "left").crossJoin(F.broadcast(total)).select(
        "source", "target_share", F.round(F.coalesce("tokens", F.lit(0)) / F.col("total"), 6).alias("share_reached"), F.coalesce("tokens", F.lit(0)).alias("tokens"),
        F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"), "max_repeats",
    )
