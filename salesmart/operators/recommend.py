"""Product recommendations from a truncated SVD of the customer × product spend matrix.

With A the spend matrix and V its top-k right singular vectors, the rank-k reconstruction is A·V·Vᵀ (no U, no
signs). V comes from a block Krylov space of AᵀA with thick restarts, for every size of catalogue: a step is two joins
and two aggregations over A, the basis stays a distributed frame, and only small matrices reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.expressions import money_sum
from salesmart.operators.affinity import number_items
from salesmart.schemas import SCORE
from salesmart.session import materialize

FACTORS = 20
TOP_N = 5
SCORE_CHUNK = 512  # customers scored at a time in a task
ITEM_BLOCK = 4096  # products per packed block of V
BANDS = 64  # of the lengths of V's rows

_RESULT = "customer_id bigint, item int, score double"


# --- inputs --------------------------------------------------------------------------------------------------


def user_item_spend(sales: DataFrame) -> DataFrame:
    """Total spend per customer and product: the long form of the user-item matrix (absent cells are zero)."""
    return sales.groupBy("customer_id", "product_id").agg(money_sum().alias("spend"))


def user_item_pivot(sales: DataFrame, products: list[int]) -> DataFrame:
    """The wide form, one column per product (``item_<id>``), for callers who want a matrix of few products.

    A sale of a product that is not listed fails the query: its spend would be lost.
    """
    listed = F.coalesce(F.col("product_id").isin(list(products)), F.lit(False))
    other = F.when(~listed, F.coalesce(F.col("product_id").cast("string"), F.lit("NULL")))
    # The check is an aggregate, so no optimizer rule can move it in front of a join and meet rows that are no sales.
    wide = user_item_spend(sales).groupBy("customer_id").agg(
        *[F.sum(F.when(F.col("product_id") == p, F.col("spend"))).alias(f"_{i}") for i, p in enumerate(products)],
        F.min(other).alias("_other"),
    )
    refused = F.raise_error(F.concat(F.lit("product not in the list: "), F.col("_other")))
    zero = F.lit(0).cast("decimal(20,2)")
    return wide.select(
        F.when(F.col("_other").isNull(), F.col("customer_id")).otherwise(refused).alias("customer_id"),
        *[F.coalesce(F.col(f"_{i}").cast("decimal(20,2)"), zero).alias(f"item_{p}".replace("-", "_"))
          for i, p in enumerate(products)],
    )


def unbought_pairs(candidates: DataFrame, bought: DataFrame) -> DataFrame:
    """Candidate (customer, product) pairs that the customer has not bought.

    Scoring does not need it: there every customer's bought products are masked inside the task, so the full
    customer × product set never exists as rows.
    """
    pair = ["customer_id", "product_id"]
    return candidates.select(*pair).distinct().join(bought.select(*pair), pair, "left_anti")


def unbought_counts(products: DataFrame, bought: DataFrame) -> DataFrame:
    """(customer_id, unbought): how many of ``products`` (product_id) each customer has never bought.

    The products left are all but those bought, so they are counted by subtraction and no pair is made for them. Products
    bought that are not among ``products`` do not count.
    """
    known = products.select("product_id").where("product_id is not null").distinct()
    pairs = bought.select("customer_id", "product_id").distinct().join(known.withColumn("listed", F.lit(1)), "product_id", "left")
    return pairs.groupBy("customer_id").agg((F.lit(known.count()) - F.count("listed")).alias("unbought"))


def product_names(sales: DataFrame, spend: DataFrame | None = None) -> DataFrame:
    """First name per product in order of customer, date and sale; NULL where that sale had no name.

    The first customer per product comes from a hash aggregation (of the smaller ``spend`` where given); only
    that customer's rows go through the ordered aggregation, which would otherwise sort every sale.
    """
    first_buyer = (sales if spend is None else spend).groupBy("product_id").agg(F.min("customer_id").alias("customer_id"))
    theirs = sales.join(first_buyer, ["product_id", "customer_id"])
    # Taking the name inside a struct keeps a NULL name of the first row.
    first = F.min_by(F.struct("product_name"), F.struct("sale_date", "sale_id"))
    return theirs.groupBy("product_id").agg(first["product_name"].alias("product_name"))


def top_per_customer(scores: DataFrame, n: int = TOP_N, score: str = "score") -> DataFrame:
    """Best ``n`` rows per customer with rank from 1; equal scores go to the smaller product id.

    Spark limits each group before the shuffle as well as after it.
    """
    order = Window.partitionBy("customer_id").orderBy(F.desc(score), "product_id")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


# --- scoring -----------------------------------------------------------------------------------------------------


def _best(scores: np.ndarray, rows: np.ndarray, items: np.ndarray, ids: np.ndarray, n: int):
    """Top ``n`` columns of every score row after removing the bought cells; ties go to the smaller id."""
    scores[rows, items] = -np.inf
    n = min(n, scores.shape[1])
    # A partition alone may cut a tie arbitrarily: keep everything at or above the n-th value, then sort exactly.
    floor = np.partition(scores, scores.shape[1] - n, axis=1)[:, scores.shape[1] - n]
    r, c = np.nonzero((scores >= floor[:, None]) & np.isfinite(scores))
    s = scores[r, c]
    order = np.lexsort((ids[c], -s, r))
    r, c, s = r[order], c[order], s[order]
    starts = np.r_[0, np.flatnonzero(np.diff(r)) + 1] if len(r) else np.zeros(0, dtype=int)
    position = np.arange(len(r)) - np.repeat(starts, np.diff(np.r_[starts, len(r)]))
    keep = position < n
    return r[keep], c[keep], s[keep]


# --- factors -----------------------------------------------------------------------------------------------------


def _columns(prefix: str, width: int) -> list[str]:
    return [f"{prefix}{j}" for j in range(width)]


def _pushed(cells: DataFrame, vectors: DataFrame, on: str, to: str, width: int) -> DataFrame:
    """Multiply the spend cells by row vectors keyed by ``on`` and sum them by ``to``."""
    sums = [F.sum(F.col("spend") * F.col(c)).alias(c) for c in _columns("v", width)]
    return cells.join(vectors, on).groupBy(to).agg(*sums)


def _tall(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """An array column of one length as a matrix."""
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _inner_products(both: DataFrame, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """QᵀR and RᵀR of the tall frame (q, z), R = Z − Q·first; only small sums leave the tasks."""
    m, b = first.shape

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((m + b, b))
        for batch in batches:
            if batch.num_rows:
                q, z = _tall(batch, "q"), _tall(batch, "z")
                rest = z - q @ first
                total += np.vstack([q.T @ rest, rest.T @ rest])
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)), pa.array(total.ravel())],
            names=["i", "j", "x"])

    parts = both.select("q", "z").mapInArrow(products, "i int, j int, x double")
    summed = parts.groupBy("i", "j").agg(F.sum("x").alias("x")).toPandas()
    out = np.zeros((m + b, b))
    out[summed["i"], summed["j"]] = summed["x"]
    return out[:m], out[m:]


def _arrays(values: np.ndarray) -> pa.Array:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(values).ravel()))


def _mixed(both: DataFrame, onto: np.ndarray, first: np.ndarray, second: np.ndarray, scale: np.ndarray) -> DataFrame:
    """(item, q, v0, v1, ...): the basis times ``onto``, with the columns ((Z − Q·first) − Q·second)·scale added to it
    and beside it."""
    names = _columns("v", scale.shape[1])

    def mix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            q, z = _tall(batch, "q"), _tall(batch, "z")
            fresh = ((z - q @ first) - q @ second) @ scale
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), _arrays(np.hstack([q @ onto, fresh])), *(pa.array(c) for c in fresh.T.copy())],
                names=["item", "q", *names])

    schema = "item int, q array<double>" + "".join(f", {c} double" for c in names)
    return both.select("item", "q", "z").mapInArrow(mix, schema)


def krylov_factors(
    cells: DataFrame, items: DataFrame, k: int, oversample: int = 10, blocks: int = 8, tolerance: float = 1e-10,
    max_steps: int = 300,
) -> tuple[DataFrame, int, int]:
    """Top-k right singular vectors of the spend cells as a frame ``(item, v0, v1, ...)``, their number, and the passes
    over the cells.

    Every step multiplies the newest block of ``k + oversample`` basis vectors by AᵀA and makes the result orthogonal to
    the whole basis, twice. A basis of ``blocks`` blocks is compressed to its best vectors and grows on. It ends when
    every wanted pair's residual is below ``tolerance`` times the largest eigenvalue, at the latest when the basis
    spans all that AᵀA reaches, and fails rather than return vectors that have not converged. Each step is written
    to the checkpoint folder, so the lineage stays short and a lost executor costs one step.
    """
    width = k + oversample
    # Start vectors from a hash of the item number: the same on every attempt of a task.
    seeds = [F.pmod(F.xxhash64(F.col("item"), F.lit(j)), F.lit(2_000_003)) / 1_000_001.5 - 1 for j in range(width)]
    both = materialize(items.select("item", F.array().cast("array<double>").alias("q"), F.array(*seeds).alias("z")))
    inner, last, largest = np.zeros((0, 0)), np.zeros((0, 0)), 0.0
    for step in range(max_steps):
        size, width = len(inner), len(last) if step else width
        first, _ = _inner_products(both, np.zeros((size, width)))
        second, square = _inner_products(both, first)
        square = (square + square.T) / 2 - second.T @ second
        values, turn = np.zeros(0), np.zeros((0, 0))
        if step:
            # The newest columns of QᵀAᵀAQ; the others are known.
            inner[:, size - len(last):] = first
            inner[size - len(last):] = first.T
            values, turn = np.linalg.eigh((inner + inner.T) / 2)
            values, turn = values[::-1], turn[:, ::-1]
            largest = values[0]
            tail = turn[size - len(last):, :k]
            rest = np.sqrt(np.maximum(np.einsum("ij,ik,kj->j", tail, square, tail), 0))
            if size >= k and (rest <= tolerance * largest).all():
                return _chosen(both, turn[:, :k]), k, step
        scale, basis = np.linalg.eigh(square)
        floor = (tolerance * largest) ** 2 if step else scale[-1] * 1e-20
        sound = scale > max(floor, scale[-1] * 1e-20)
        if not sound.any():  # the basis holds all that the matrix reaches
            rank = min(k, int((values > largest * 1e-14).sum()))
            return _chosen(both, turn[:, :rank]), rank, step
        onto = np.eye(size)
        if size + int(sound.sum()) > blocks * (k + oversample):
            onto, inner = turn[:, : k + oversample], np.diag(values[: k + oversample])
        fresh = basis[:, sound] / np.sqrt(scale[sound])
        grown = _mixed(both, onto, first, second, fresh)
        last = np.zeros((fresh.shape[1], 1))
        inner = np.pad(inner, (0, len(last)))
        names = _columns("v", len(last))
        image = _pushed(cells, _pushed(cells, grown.drop("q"), "item", "customer_id", len(last)), "customer_id", "item",
                        len(last))
        both = materialize(grown.select("item", "q").join(image.select("item", F.array(*names).alias("z")), "item"))
    raise RuntimeError(f"no convergence after {max_steps} steps: raise max_steps, blocks or oversample")


def _chosen(both: DataFrame, mix: np.ndarray) -> DataFrame:
    """(item, v0, v1, ...): the basis times a small matrix."""
    names = _columns("v", mix.shape[1])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), *(pa.array(c) for c in (_tall(batch, "q") @ mix).T.copy())], names=["item", *names])

    return both.select("item", "q").mapInArrow(apply, "item int" + "".join(f", {c} double" for c in names))


class Shelves:
    """Products in blocks of about ITEM_BLOCK by falling length of their row of V.

    Lengths fall in bands of a quarter of a doubling, at most BANDS of them whatever the catalogue; small neighbouring
    bands share a block, large ones are cut by a hash, so products of one length do not make one block.
    """

    def __init__(self, factors: DataFrame, items: DataFrame, width: int) -> None:
        v = _columns("v", width)
        rows = materialize(factors.join(items.select("item", "product_id"), "item").select(
            "item", "product_id", F.array(*v).alias("q"), F.sqrt(sum((F.col(c) * F.col(c) for c in v[1:]), F.col(v[0]) * F.col(v[0]))).alias("length")))
        longest = rows.agg(F.max("length")).first()[0]
        band = F.when(F.col("length") > 0, F.least(F.lit(BANDS), F.floor(4 * F.log2(F.lit(longest) / F.col("length"))))).otherwise(F.lit(BANDS)).cast("int")
        rows = rows.withColumn("band", band)
        sizes = rows.groupBy("band").agg(F.count("*").alias("n"), F.max("length").alias("bound")).orderBy("band").collect()
        self.bands: list[tuple[int, int, float]] = []  # first and last block, longest row
        first, parts, room = -1, [], 0
        for number, size, bound in sizes:
            cuts = -(-size // ITEM_BLOCK)
            if cuts == 1 and size <= room:
                room -= size
            else:
                first = (self.bands[-1][1] if self.bands else -1) + 1
                room = ITEM_BLOCK - size if cuts == 1 else 0
            self.bands.append((first, first + cuts - 1, bound))
            parts.append(F.when(F.col("band") == number, first + F.pmod(F.xxhash64("item"), F.lit(cuts))))
        self.rows = rows.withColumn("block", F.coalesce(*parts).cast("int")).drop("band", "length")
        self.blocks = self.bands[-1][1] + 1

    def needed(self, length, floor, start: int, end: int):
        """The blocks from ``start`` to before ``end`` where a row of this length could reach ``floor``: by Cauchy and
        Schwarz no score exceeds the product of the lengths. Ties with the floor count, rounding is allowed for."""
        best: dict[int, float] = {}
        for first, last, bound in self.bands:
            for block in (first,) if first == last else range(first, last + 1):
                best[block] = max(bound, best.get(block, 0.0))
        spans: list[list] = []  # neighbouring blocks with one bound are one entry
        for block in range(start, end):
            if spans and spans[-1][2] == best[block]:
                spans[-1][1] = block
            else:
                spans.append([block, block, best[block]])
        known = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(float(x)).alias("bound")) for i, j, x in spans))
        good = F.filter(known, lambda s: floor.isNull() | (length * s["bound"] * (1 + 1e-9) >= floor))
        return F.flatten(F.transform(good, lambda s: F.sequence(s["i"], s["j"])))


def best_scores(cells: DataFrame, factors: DataFrame, width: int, items: DataFrame, top_n: int, n_customers: int,
                scored: list[int] | None = None) -> DataFrame:
    """(customer_id, item, score): at least the best ``top_n`` unbought products of every customer.

    The first block holds the products with the longest rows of V. Each round scores twice as many blocks as all rounds
    before, for the customers only whose n-th score so far a product there could still reach; who is out of reach of
    the next band leaves for good, since lengths fall. A catalogue of one block is one round. Customers and products
    travel in packs, one joined row stands for millions of scores, and a pack is reduced to ``top_n`` a customer in the
    task that made it. The number of scores computed goes to ``scored``, if given.
    """
    shelves = Shelves(factors, items, width)
    latent = _pushed(cells, factors, "item", "customer_id", width).select("customer_id", F.array(*_columns("v", width)).alias("p"))
    bought = cells.join(shelves.rows.select("item", "block"), "item").groupBy("customer_id").agg(
        F.collect_list(F.struct("block", "item")).alias("bought"))
    length = F.sqrt(F.aggregate("p", F.lit(0.0), lambda total, x: total + x * x))
    people = latent.join(bought, "customer_id").withColumn("length", length).withColumn("floor", F.lit(None).cast("double"))
    if shelves.blocks > 1:
        people = materialize(people)
    start, found = 0, None
    while start < shelves.blocks:
        end = min(shelves.blocks, max(1, 2 * start))
        now = people.withColumn("block", F.explode(shelves.needed(F.col("length"), F.col("floor"), start, end)))
        if scored is not None:
            sizes = shelves.rows.groupBy("block").agg(F.count("*").alias("n"))
            scored.append(now.join(sizes, "block").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
        fresh = _scored(now, shelves.rows.where(F.col("block").between(start, end - 1)), top_n, n_customers)
        found = fresh if found is None else found.unionByName(fresh)
        start = end
        if start < shelves.blocks:
            found = materialize(top_per_customer(found.join(items.select("item", "product_id"), "item"), top_n)).select(
                "customer_id", "item", "score")
            floors = found.groupBy("customer_id").agg(F.when(F.count("*") >= top_n, F.min("score")).alias("floor"))
            people = people.drop("floor").join(floors, "customer_id", "left")
            people = materialize(people.where(F.size(shelves.needed(F.col("length"), F.col("floor"), start, shelves.blocks)) > 0))
            if people.isEmpty():
                break
    return found


def _scored(people: DataFrame, products: DataFrame, top_n: int, n_customers: int) -> DataFrame:
    """Best ``top_n`` products per customer and block, of rows (customer_id, p, bought, block).

    The join key is (block, slot): sixteen packs of customers share a slot, so a copy of a block serves thousands of
    customers and no block becomes one task.
    """
    chunks = max(1, -(-n_customers // SCORE_CHUNK))
    spread = -(-chunks // 16)
    # What a customer bought travels to the block it belongs to only.
    here = F.transform(F.filter("bought", lambda x: x["block"] == F.col("block")), lambda x: x["item"])
    packed = (
        people.select("block", F.struct("customer_id", "p", here.alias("bought")).alias("person"),
                      F.pmod(F.xxhash64("customer_id"), F.lit(chunks)).alias("chunk"))
        .groupBy("block", "chunk").agg(F.collect_list("person").alias("people"))
        .select("block", F.pmod("chunk", F.lit(spread)).alias("slot"), "people")
    )
    shelves = (
        products.groupBy("block").agg(F.collect_list(F.struct("item", "product_id", "q")).alias("shelf"))
        .withColumn("slot", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(spread - 1).cast("bigint"))))
    )
    schema = pa.schema([("customer_id", pa.int64()), ("item", pa.int32()), ("score", pa.float64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                people = batch.column("people").slice(row, 1).flatten()
                shelf = batch.column("shelf").slice(row, 1).flatten()
                item, ids = shelf.field("item").to_numpy(), shelf.field("product_id").to_numpy()
                p = people.field("p").flatten().to_numpy().reshape(len(people), -1)
                q = shelf.field("q").flatten().to_numpy().reshape(len(shelf), -1)
                bought = people.field("bought")
                lengths = np.diff(bought.offsets.to_numpy())
                owner, cols = np.repeat(np.arange(len(people)), lengths), bought.flatten().to_numpy()
                by_item = np.argsort(item)
                place = by_item[np.searchsorted(item, cols, sorter=by_item)]
                who, what, value = _best(p @ q.T, owner, place, ids, top_n)
                columns = [people.field("customer_id").to_numpy()[who], item[what].astype(np.int32), value]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    return packed.join(shelves, ["block", "slot"]).select("people", "shelf").mapInArrow(score, _RESULT)


# --- the operator --------------------------------------------------------------------------------------------------


def recommend(
    sales: DataFrame,
    factors: int = FACTORS,
    top_n: int = TOP_N,
    name_fallback: bool = False,
) -> DataFrame:
    """Top ``top_n`` unbought products per customer by reconstructed spend.

    Ranks come from the unrounded scores. The factor count is at most one below the smaller side of the matrix;
    with a single customer or product there is nothing to recommend.
    """
    sales = materialize(sales.select("customer_id", "product_id", "product_name", "amount", "sale_date", "sale_id"))
    spend = materialize(user_item_spend(sales))
    n_items, n_customers = spend.agg(F.count_distinct("product_id"), F.count_distinct("customer_id")).first()
    k = min(factors, min(n_items, n_customers) - 1)
    names = product_names(sales, spend)
    if k < 1:
        empty = spend.where(F.lit(False)).join(names, "product_id")
        return empty.select("customer_id", "product_id", "product_name", F.lit(0).cast(SCORE).alias("score"), F.lit(0).alias("rank"))
    items = materialize(number_items(spend.select("product_id").distinct(), "product_id"))
    cells = materialize(
        spend.join(items, "product_id").select("customer_id", "item", F.col("spend").cast("double").alias("spend")))
    vectors, width, _ = krylov_factors(cells, items, k)
    scored = best_scores(cells, materialize(vectors), width, items, top_n, n_customers)
    best = top_per_customer(scored.join(items, "item"), top_n)
    named = best.join(names, "product_id", "left")
    label = F.col("product_name")
    if name_fallback:
        label = F.coalesce(label, F.concat(F.lit("Product_"), F.col("product_id").cast("string")))
    return named.select(
        "customer_id",
        "product_id",
        label.alias("product_name"),
        F.round("score", 4).cast(SCORE).alias("score"),
        "rank",
    )
