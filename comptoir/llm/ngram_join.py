"""Exact self join of word-shingle sets by Jaccard similarity, by universe partition.

A document is its set of five-word shingles. Two sets of sizes s and l that link
(Jaccard of at least 75%) differ in at most ``H = (s + l) / 7`` shingles. The
sets are joined as follows.

1. *Size bands.* Band k holds sizes from ``a`` up to about ``1.5 a``; a set also
   enters the next band if a partner may be there, so linked sets share a band.
2. *Universe partition.* A band hashes all shingles into m segments. What a set
   has in a segment is the segment's subset, known by one 64-bit signature.
3. *Allocation by cost.* Linked sets differ in at most H segments, so H + 1
   subsets of a set include an equal one. Each set indexes its H + 1 cheapest:
   the cost of a subset is the frequency of its rarest shingle. All sets of a
   band use one order of subsets (cost, then signature), so the first equal
   subset of two linked sets is among the chosen of both.
4. *One-deletion neighbourhoods.* A set that has too few non-empty subsets
   indexes all of them, and each with any one shingle left out. Between two
   such sets a subset counts for two differences. If even that is too little
   (all of a small set in one segment), the set enters a group of its band
   for such sets.
5. *Verification.* Sets that share a signature are candidates. Groups of up to
   ``GROUP`` give pairs; a pair whose parity sketches (a bit per hash bucket,
   set if it holds an odd number of shingles) differ in more than H bits
   differs in more than H shingles and is dropped. The sets of larger groups
   are gathered by the connected parts that these groups form and compared in
   blocks by matrix products, so that common passages and thousands of near
   copies do not become rows. Both compare whole sets, exactly.

Copies of one set are one class throughout. Frequencies only set the order in
step 3: any values give the same links. Everything that grows with the input is
dealt by hash into parts of a bounded size, and what a task needs of the corpus
as a whole are at most ``COMMON`` frequent shingles.

Nulls: a null text, and one without words, has an empty set and is linked with
nothing. A null id stays null; it never names a component that has another id,
and of a group's rows one without an id is kept only if no row has one.
Repeated rows are copies. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from comptoir.llm.components import components
from comptoir.llm.shingles import mixed, shingle_sets
from comptoir.operators.lookups import lookup_join
from comptoir.sources.stores import written

#: Shingles whose frequency is known to all tasks; others count as rare.
COMMON = 1 << 20
#: A task reports a shingle that it saw so often in ``BUFFER`` shingles.
REPORTED, BUFFER = 4, 1 << 21
#: Signatures in one part of the index, about; and the least number of parts.
PART, LEAST_PARTS = 1 << 20, 16
#: Bytes of a signature that are stored beside its part: candidates are verified, so it may be cut.
STORED_BYTES = 5
#: A group with more sets is compared in blocks, not by pairs.
GROUP = 64
#: Sets, and shingles, on each side of a block, about.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 21
LEFT, RIGHT, BOTH = 0, 1, 2
#: Ids that may be broadcast to find the texts of candidates (8 bytes each); beyond, they are joined.
BROADCAST_IDS = 2_000_000
#: Documents whose sets a worker holds at a time.
TEXTS = 500

np.seterr(over="ignore")  # hashes wrap around


def linked(shared, a, b):
    """Whether sets of sizes a and b with so many shingles in common link; for numbers, arrays and columns."""
    return 100 * shared >= 75 * (a + b - shared)


@cache
def _bands() -> np.ndarray:
    """First size of each band. A band's first size is at least 4/3 of the one before."""
    found = [1]
    while found[-1] < 1 << 40:
        found.append(max(found[-1] + 1, found[-1] * 3 // 2))
    return np.array(found)


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for start in range(0, len(batch), TEXTS):
            yield batch.iloc[start:start + TEXTS]


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of each slice ``bounds[i]:bounds[i + 1]``, 0 where it is empty; wraps around."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _identities(tokens: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit fingerprints of each set; the first is its name in the index."""
    size = np.diff(bounds).astype(np.uint64)
    first = mixed(_sums(mixed(tokens, 11), bounds) + size, 12)
    return first.view(np.int64), mixed(_sums(mixed(tokens, 13), bounds) + size, 14).view(np.int64)


def _parities(tokens: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Of each set the parity of its count in hash buckets, two to four per shingle, 64 to a number."""
    size = np.diff(bounds)
    bits = np.maximum(6, np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64) + 1)
    starts = np.cumsum(1 << bits) - (1 << bits)
    owner = np.repeat(np.arange(len(size)), size)
    bucket = (mixed(tokens, 15) & ((1 << bits[owner]) - 1).astype(np.uint64)).astype(np.int64)
    counts = np.bincount(starts[owner] + bucket, minlength=int((1 << bits).sum()))
    words = np.packbits((counts & 1).astype(np.uint8)).view(np.int64)
    return [words[a:b] for a, b in zip(starts // 64, (starts + (1 << bits)) // 64)]


def _may_link(a: str, b: str) -> Column:
    """False for pairs (columns ``{a}_n`` and ``{a}_parity``) whose sketches show too many differences.

    A sketch twice as fine is first folded: a bucket's halves lie half the sketch apart.
    """
    fewer = F.least(F.size(f"{a}_parity"), F.size(f"{b}_parity"))

    def folded(side: str) -> Column:
        parity = F.col(f"{side}_parity")
        halves = F.slice(parity, 1, fewer), F.slice(parity, fewer + 1, fewer)
        return F.when(F.size(parity) == fewer, parity).otherwise(F.zip_with(*halves, lambda x, y: x.bitwiseXOR(y)))

    differing = F.aggregate(
        F.zip_with(folded(a), folded(b), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    n = F.col(f"{a}_n") + F.col(f"{b}_n")
    sizes = 4 * F.least(f"{a}_n", f"{b}_n") >= 3 * F.greatest(f"{a}_n", f"{b}_n")
    return sizes & (F.coalesce(differing, F.lit(0)) <= F.floor(n / 7))


# -- first pass: sizes, fingerprints, frequent shingles ----------------------------------

def _measured(keyed: bool):
    """One row per document, and rows of frequent shingles; if ``keyed``, the column ``key`` goes along."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, amount = [], 0

        def frequent() -> pd.DataFrame:
            values, counts = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64),) * 2
            often = counts >= REPORTED
            nothing = pd.Series([None] * int(often.sum()), dtype=object)
            return pd.DataFrame({
                "doc_id": nothing, **({"key": nothing} if keyed else {}), "n": counts[often].astype(np.int64),
                "id": values[often].view(np.int64), "check": np.zeros(int(often.sum()), np.int64), "shingle": True,
                "parity": nothing})

        for piece in _pieces(batches):
            tokens, bounds = shingle_sets(piece["text"])
            first, second = _identities(tokens, bounds)
            yield pd.DataFrame({
                "doc_id": piece["doc_id"].to_numpy(), **({"key": piece["key"].to_numpy()} if keyed else {}), "n": np.diff(bounds), "id": first,
                "check": second, "shingle": False, "parity": _parities(tokens, bounds)})
            held, amount = [*held, tokens], amount + len(tokens)
            if amount >= BUFFER:
                yield frequent()
                held, amount = [], 0
        yield frequent()
    return rows


# -- second pass: signatures --------------------------------------------------------------

class Costs:
    """Cost of shingles: the bit length of their frequency, 0 for rare ones."""

    def __init__(self, shingles: np.ndarray, counts: np.ndarray):
        order = np.argsort(shingles)
        self.shingles = shingles[order]
        self.costs = np.log2(np.maximum(counts[order], 1)).astype(np.uint8)

    def of(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.shingles):
            return np.zeros(len(tokens), np.uint8)
        at = np.minimum(np.searchsorted(self.shingles, tokens), len(self.shingles) - 1)
        return np.where(self.shingles[at] == tokens, self.costs[at], 0).astype(np.uint8)


def signatures(tokens: np.ndarray, bounds: np.ndarray, costs: Costs) -> tuple[np.ndarray, np.ndarray]:
    """(set, signature) rows of the index for a batch of sets."""
    sizes, bands = np.diff(bounds), _bands()
    band = np.searchsorted(bands, sizes, "right") - 1
    some = np.flatnonzero(sizes > 0)
    upper = bands[band + 1]
    also = some[4 * sizes[some] >= 3 * upper[some]]  # a partner may be in the next band
    # A copy of the set in each of its bands.
    of = np.concatenate([some, also])
    cell = np.concatenate([band[some], band[also] + 1])
    n = sizes[of]
    partner = np.minimum(4 * n // 3, bands[cell + 1] - 1)
    needed = (n + partner) // 7 + 1
    segments = np.maximum(64, 4 * (bands[cell + 1] - 1) // 7 + 2).astype(np.uint64)

    owner = np.repeat(np.arange(len(of)), n)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(bounds[of], n)
    token = tokens[at]
    segment = (mixed(token, 1) >> np.uint64(32)) * segments[owner] >> np.uint64(32)
    order = np.argsort((owner.astype(np.uint64) << np.uint64(40)) | segment, kind="stable")
    owner, token, segment = owner[order], token[order], segment[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (segment[1:] != segment[:-1])
    first = np.flatnonzero(new)
    if not len(first):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    content = mixed(token, 2)
    summed = _sums(content, np.append(first, len(token)))
    place = mixed((cell[owner].astype(np.uint64) << np.uint64(40)) | segment, 3)
    signature = mixed(summed + place[first], 4)
    cost = np.minimum.reduceat(costs.of(token), first)
    members = np.diff(np.append(first, len(token)))

    # The cheapest subsets of each set.
    holder = owner[first]
    ranked = np.lexsort((signature, cost, holder))
    rank = np.arange(len(ranked)) - np.searchsorted(holder[ranked], holder[ranked])
    chosen = ranked[rank < needed[holder[ranked]]]
    owners, values = [holder[chosen]], [signature[chosen]]

    # Too few subsets: deletions, and the band's own group if those are too few as well.
    subsets = np.bincount(holder, minlength=len(of))
    units = np.bincount(holder, np.minimum(members, 2), minlength=len(of))
    few = subsets < needed
    if few.any():
        shrunk = few[owner] & np.repeat(members >= 2, members)
        owners.append(owner[shrunk])
        values.append(mixed(np.repeat(summed, members)[shrunk] - content[shrunk] + place[shrunk], 4))
        rest = np.flatnonzero(few & (units < needed))
        owners.append(rest)
        values.append(mixed(cell[rest].astype(np.uint64), 5))
    return of[np.concatenate(owners)], np.concatenate(values)


def _indexed(common, parts: int):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        costs = Costs(*common.value)
        seen: set[int] = set()  # classes that this task has indexed; forgotten when large
        for piece in _pieces(batches):
            tokens, bounds = shingle_sets(piece["text"])
            name, _ = _identities(tokens, bounds)
            of, signature = signatures(tokens, bounds, costs)
            kept = np.zeros(len(name), bool)
            for i, x in enumerate(name.tolist()):
                if x not in seen:
                    seen.add(x)
                    kept[i] = True
            if len(seen) > 1 << 18:
                seen.clear()
            of, signature = of[kept[of]], signature[kept[of]]
            part = signature % np.uint64(parts)
            order = np.argsort(part, kind="stable")
            of, signature, part = of[order], signature[order], part[order]
            edges = np.flatnonzero(np.diff(part, prepend=np.uint64(parts), append=np.uint64(parts)))
            packed = []
            for start, end in zip(edges, edges[1:]):
                held, at = np.unique(of[start:end], return_inverse=True)
                bits = np.ascontiguousarray(signature[start:end] // np.uint64(parts)).view(np.uint8).reshape(-1, 8)
                packed.append((
                    int(part[start]), name[held].tobytes(), at.astype(np.uint16).tobytes(),
                    np.ascontiguousarray(bits[:, :STORED_BYTES]).tobytes()))
            yield pd.DataFrame(packed, columns=["part", "sets", "of", "signature"])
    return rows


def _candidates(part: pd.DataFrame) -> pd.DataFrame:
    """Pairs of sets of one part that share a signature; stars in place of pairs for large groups."""
    names, values = [], []
    for sets, of, signature in zip(part["sets"], part["of"], part["signature"]):
        names.append(np.frombuffer(sets, np.int64)[np.frombuffer(of, np.uint16)])
        cut = np.zeros((len(names[-1]), 8), np.uint8)
        cut[:, :STORED_BYTES] = np.frombuffer(signature, np.uint8).reshape(-1, STORED_BYTES)
        values.append(cut.view(np.uint64).ravel())
    name, value = np.concatenate(names), np.concatenate(values)
    del names, values
    order = np.lexsort((name, value))
    name, value = name[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (name[1:] != name[:-1])
    name, value = name[new], value[new]
    first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    length = np.diff(np.append(first, len(value)))
    left, right, large = [], [], []
    for n in np.unique(length[(length > 1) & (length <= GROUP)]):
        group = first[length == n][:, None] + np.arange(n)
        i, j = np.triu_indices(n, 1)
        left.append(name[group[:, i].ravel()])
        right.append(name[group[:, j].ravel()])
        large.append(np.zeros(len(left[-1]), bool))
    for start, n in zip(first[length > GROUP], length[length > GROUP]):
        left.append(np.full(n, name[start]))
        right.append(name[start:start + n])
        large.append(np.ones(n, bool))
    if not left:
        return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64), "large": np.zeros(0, bool)})
    pairs = np.stack([np.concatenate(left), np.concatenate(right), np.concatenate(large).astype(np.int64)], axis=1)
    order = np.lexsort(pairs.T)
    pairs = pairs[order]
    new = np.ones(len(pairs), bool)
    new[1:] = (pairs[1:] != pairs[:-1]).any(axis=1)
    pairs = pairs[new]
    return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1], "large": pairs[:, 2] == 1})


# -- verification ----------------------------------------------------------------------------

def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for piece in _pieces(batches):
        tokens, bounds = shingle_sets(piece["text"])
        name, _ = _identities(tokens, bounds)
        signed = tokens.view(np.int64)
        yield pd.DataFrame({"id": name, "tokens": [signed[a:b] for a, b in zip(bounds, bounds[1:])]})


def _products(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many shingles each left set shares with each right one."""
    both = np.concatenate([*left, *right])
    values, at = np.unique(both, return_inverse=True)
    often = np.bincount(at, minlength=len(values)) > 1
    column = np.cumsum(often) - 1
    row = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in (*left, *right)])
    kept = often[at]
    row, col, total = row[kept], column[at[kept]], int(often.sum())
    shared = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, total, 4096):  # so many columns of the matrices at a time
        here = (col >= start) & (col < start + 4096)
        dense = np.zeros((len(left) + len(right), min(4096, total - start)), np.float32)
        dense[row[here], col[here] - start] = 1
        shared += dense[:len(left)] @ dense[len(left):].T
    return shared


def _block_links(sets: pd.DataFrame) -> pd.DataFrame:
    """A spanning forest of the links between two blocks, or within one."""
    left, right = sets[sets["side"] != RIGHT], sets[sets["side"] != LEFT]
    a, b = left["id"].to_numpy(), right["id"].to_numpy()
    sets_a, sets_b = list(left["tokens"]), list(right["tokens"])
    size_a, size_b = np.array([len(x) for x in sets_a], np.float64), np.array([len(x) for x in sets_b], np.float64)
    found_a, found_b, root = [], [], {}

    def top(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    if len(a) and len(b):
        shared = _products(sets_a, sets_b).astype(np.float64)
        for i, j in zip(*np.nonzero(linked(shared, size_a[:, None], size_b[None, :]))):
            x, y = top(int(a[i])), top(int(b[j]))
            if x != y:
                root[max(x, y)] = min(x, y)
                found_a.append(int(a[i]))
                found_b.append(int(b[j]))
    return pd.DataFrame({"a": np.array(found_a, np.int64), "b": np.array(found_b, np.int64)})


def _near_pairs(pairs: DataFrame, measured: DataFrame) -> DataFrame:
    """The pairs without those that the sizes and sketches rule out."""
    paired = pairs.select(F.col("a").alias("paired")).unionAll(pairs.select("b")).distinct()
    # One row per class before the join, so that a large class does not meet in one task.
    classes = measured.groupBy("id").agg(F.first("n").alias("n"), F.first("parity").alias("parity"))
    sketches = written(classes.join(paired, F.col("id") == F.col("paired"), "left_semi"), "join-sketches")
    side = lambda name: sketches.select(*(F.col(c).alias(name if c == "id" else f"{name}_{c}") for c in sketches.columns))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(_may_link("a", "b")).select("a", "b")


def _pair_links(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    side = lambda name: sets.select(F.col("id").alias(name), F.col("tokens").alias(f"{name}_tokens"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    shared = F.size(F.array_intersect("a_tokens", "b_tokens"))
    return both.where(linked(shared, F.size("a_tokens"), F.size("b_tokens"))).select("a", "b")


def _group_links(stars: DataFrame, sets: DataFrame) -> DataFrame:
    """Links among the sets of large groups: each connected part of the stars, in blocks of a bounded size."""
    part = components(stars).join(sets.select("id", F.size("tokens").alias("n")), F.col("node") == F.col("id"))
    part = written(part.select("component", "node", "n"), "join-groups")
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    sizes = part.groupBy("component").agg(blocks.alias("blocks"))
    placed = part.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    placed = placed.join(sets, F.col("node") == F.col("id")).select("component", "blocks", "block", "id", "tokens")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    # Each set meets every block once: as the left side where its block is the smaller one.
    met = placed.select("component", "block", "id", "tokens", other)
    side = F.when(F.col("block") < F.col("other"), LEFT).when(F.col("block") > F.col("other"), RIGHT).otherwise(BOTH)
    met = met.select(
        "component", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
        side.alias("side"), "id", "tokens")
    return met.groupBy("component", "x", "y").applyInPandas(_block_links, "a long, b long")


def _of_candidates(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, tokens) of the wanted classes, from one text each."""
    wanted = written(wanted, "join-wanted")
    rows = wanted.count()
    chosen = F.broadcast(wanted) if rows <= BROADCAST_IDS else wanted
    texts = docs.join(chosen, docs["doc_id"].eqNullSafe(wanted["rep"])).select("text", F.col("id").alias("named"))
    # The text of a repeated id may be another one: the fingerprint decides.
    sets = texts.select("text").mapInPandas(_sets, "id long, tokens array<long>")
    return sets.join(wanted.select("id"), "id", "left_semi").dropDuplicates(["id"])


# -- the operator -----------------------------------------------------------------------------

def _labelled(docs: DataFrame, key: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The documents as (doc_id, n, id, check) and their classes as (id, check, rep, component), both stored.

    With ``key`` the documents carry a column of that name too.
    """
    carried = [] if key is None else ["key"]
    spark, docs = docs.sparkSession, docs.select("doc_id", "text", *(key.alias(c) for c in carried))
    # Ids travel as text, as pandas would round large ones beside a null.
    named = docs.select(F.col("doc_id").cast("string").alias("doc_id"), *carried, "text")
    schema = f"doc_id string, {'key string, ' if carried else ''}n long, id long, check long, shingle boolean, parity array<long>"
    measured = written(named.mapInPandas(_measured(bool(carried)), schema), "join-sizes")
    known = measured.where("not shingle").select(F.col("doc_id").cast("long").alias("doc_id"), *carried, "n", "id", "check")
    often = measured.where("shingle").groupBy("id").agg(F.sum("n").alias("n"))
    common = often.orderBy(F.desc("n"), "id").limit(COMMON).toPandas()  # at most 16 bytes times COMMON
    frequent = spark.sparkContext.broadcast((common["id"].to_numpy(np.int64).view(np.uint64), common["n"].to_numpy(np.int64)))
    shingles = known.agg(F.sum("n")).first()[0] or 0
    parts = max(LEAST_PARTS, shingles // (2 * PART))

    index = docs.select("text").mapInPandas(_indexed(frequent, parts), "part int, sets binary, of binary, signature binary")
    found = written(index.groupBy("part").applyInPandas(_candidates, "a long, b long, large boolean"), "join-candidates")
    pairs = written(found.where("not large").select("a", "b").distinct(), "join-pairs")
    pairs = written(_near_pairs(pairs, measured.where("not shingle")), "join-near-pairs")
    stars = written(found.where("large").select("a", "b").distinct(), "join-stars")

    classes = written(known.where("n > 0").groupBy("id", "check").agg(F.min("doc_id").alias("rep")), "join-classes")
    involved = pairs.select("a").unionAll(pairs.select("b")).unionAll(stars.select("a")).unionAll(stars.select("b"))
    wanted = involved.distinct().join(classes.groupBy("id").agg(F.min("rep").alias("rep")), F.col("a") == F.col("id"))
    sets = written(_of_candidates(docs, wanted.select("id", "rep")), "join-sets")
    links = written(_pair_links(pairs, sets).unionAll(_group_links(stars, sets)), "join-links")

    part = components(links)
    labelled = classes.join(part, F.col("id") == F.col("node"), "left")
    labelled = labelled.select("id", "check", "rep", F.coalesce("component", "id").alias("component"))
    return known, written(labelled, "join-labels")


def _class() -> Column:
    return F.struct("id", "check").alias("class")


def join_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id: one row per document.

    ``component_id`` is the smallest id reachable by links.
    """
    known, labelled = _labelled(docs)
    least = labelled.groupBy("component").agg(F.min("rep").alias("component_id"))
    placed = lookup_join(labelled, least, "component", "inner").select(_class(), "component_id")
    of = lookup_join(known.withColumn("class", _class()), placed, "class")  # a class may hold any share of the rows
    return of.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """One document of each group of linked ones; columns as in ``docs``.

    It is the one with the smallest id, rows without an id last; then the class
    and the text's hash decide. Ids do not link: another text under the id of a
    linked one is judged by itself. Of rows with one id and one text one stays,
    but texts without a word are linked with nothing, so without an id all stay.
    """
    key = F.coalesce(F.md5("text"), F.lit(""))
    known, labelled = _labelled(docs, key)
    rows = lookup_join(known.withColumn("class", _class()), labelled.select(_class(), "component"), "class")
    rows = written(rows.groupBy("doc_id", "key", "n", "id", "check", "component").agg(F.count(F.lit(1)).alias("times")), "join-rows")
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "id", "check", "key")
    first = rows.where("n > 0").groupBy("component").agg(F.min(order).alias("first"))
    placed = lookup_join(rows.where("n > 0"), first, "component", "inner")
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("key") == F.col("first.key"))
    names = lambda df: df.select(F.col("doc_id").alias("_of"), F.col("key").alias("_key"))
    away = written(names(placed.where(~stays)), "join-away")
    again = names(placed.where(stays).where("times > 1").select("doc_id", "key")).unionAll(
        names(rows.where("n = 0 AND doc_id IS NOT NULL AND times > 1")))
    again = written(again, "join-repeated")

    def met(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        right = F.broadcast(right) if right.count() <= BROADCAST_IDS // 4 else right
        return left.join(right, F.col("doc_id").eqNullSafe(F.col("_of")) & (key == F.col("_key")), how)

    kept = met(docs, away, "left_anti")
    if again.isEmpty():
        return kept
    return met(kept, again, "left_anti").unionAll(met(kept, again, "left_semi").dropDuplicates(["doc_id", "text"]))


#: For small tables: all pairs that share a shingle, then all that can be reached from a document.
JOIN_DOCUMENTS_SQL = """
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
shingles AS (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
classes AS (SELECT list_sort(s) AS s, min(r) AS c, min(doc_id) AS least, len(any_value(s)) AS n FROM shingles GROUP BY list_sort(s)),
flat AS (SELECT c, n, unnest(s) AS t FROM classes),
links AS (
  SELECT a.c AS a, b.c AS b FROM flat a JOIN flat b ON a.t = b.t AND a.c <> b.c
  GROUP BY a.c, b.c HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))),
reached AS (SELECT c AS a, c AS b FROM classes UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a),
components AS (SELECT a, min(least) AS least FROM reached JOIN classes ON b = c GROUP BY a)
SELECT doc_id, n::BIGINT AS n_shingles, CASE WHEN n = 0 THEN doc_id ELSE coalesce(p.least, doc_id) END AS component_id
FROM shingles x JOIN classes k ON list_sort(x.s) = k.s JOIN components p ON p.a = k.c
"""
