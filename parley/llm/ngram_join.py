"""N-gram Jaccard join through a token-group matrix: similar sets form groups, each group keeps the union of its tokens,
and only groups whose union could hold a partner are opened."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parley.llm.common import connected, frugal, joined_sets, maybe_among, slices, stored

#: Words a shingle; least Jaccard similarity in hundredths.
WORDS, PERCENT = 4, 85
#: Prefix tokens that two groups have to share to meet: one for so many tokens of a set, but this many at least. More
#: tokens make the prefixes longer and chance meetings rarer; no link is lost either way.
SHARED_OF, SHARED = 25, 4
#: Tokens are counted in one of so many texts; a token of at least so many of these is frequent and comes last in the token
#: order; of at most so many tokens the count is kept, the most frequent ones. The order changes no result, only how many sets meet.
COUNTED_OF, FREQUENT, MOST_FREQUENT = 16, 4, 1 << 20
#: Groups that share one prefix token are paired if they are so many at most; more are put together as they are, and
#: matched as one set.
MOST_PAIRED = 200
#: Tokens and sets that one matching task holds; larger candidate sets are matched in blocks.
TASK_TOKENS, TASK_SETS = 4_000_000, 4_000
#: Rows of prefix tokens that a task pairs at once, and more only of one token.
PAIRED_ROWS = 1 << 16

_BASE = np.uint64(0x100000001B3 * 2 + 1)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of an odd number modulo 2**64, and of its inverse."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            self.up = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n - 1, _BASE))])
            self.down = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n - 1, inverse))])
        return self.up, self.down


_powers = _Powers()
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(64-bit hash and length of each word of all texts in turn, number of words of each text). Words are runs of bytes other than
    ASCII white space."""
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(space.view(np.int8), prepend=np.int8(1)))
    starts, stops = edge[::2], edge[1::2]
    up, down = _powers.upto(len(data) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])])
    hashes = _mixed((total[stops] - total[starts]) * down[starts] + (stops - starts).astype(np.uint64))
    ends = np.cumsum([len(r) + 1 for r in raw])
    return hashes, stops - starts, np.diff(np.searchsorted(starts, ends), prepend=0)


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes of each whole text; of fewer words, one of the whole sequence; of none, none."""
    return [s for s, _ in sized_shingle_sets(texts, words)]


def sized_shingle_sets(texts: list[str | None], words: int = WORDS) -> list[tuple[np.ndarray, np.ndarray]]:
    """(set, bytes of each of its shingles) of each whole text."""
    if not texts:
        return []
    hashes, lengths, sizes = word_hashes([t.encode("utf-8", "surrogatepass").lower() if t else b"" for t in texts])
    rolled = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
    for k in range(words):
        rolled = _mixed(rolled + hashes[k : k + len(rolled)] * np.uint64(2 * k + 3))
    span = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)])
    span = span[words:] - span[:-words] if len(lengths) >= words else np.zeros(0, np.int64)
    out, at = [], 0
    for n in sizes.tolist():
        if n >= words:
            own, first = np.unique(rolled[at : at + n - words + 1], return_index=True)
            out.append((own, span[at : at + n - words + 1][first]))
        elif n:
            # a short sequence has a hash of its own kind, so that it never equals a longer one's shingle
            out.append((np.array([xxhash.xxh3_64_intdigest(hashes[at : at + n].tobytes(), seed=n)], np.uint64), lengths[at : at + n].sum(keepdims=True)))
        else:
            out.append((np.zeros(0, np.uint64), np.zeros(0, np.int64)))
        at += n
    return out


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def least_shared(n: int, percent: int = PERCENT) -> int:
    """Tokens that a set of n shares at least with any partner."""
    return -(-percent * n // 100)


def must_meet(n: int, percent: int = PERCENT) -> int:
    """Tokens that the prefixes of a set of n and of any partner share at least, given how long they are made."""
    return min(least_shared(n, percent), max(SHARED, n // SHARED_OF))


class Clusters:
    """Union-find; the least index of a cluster is its root."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def unite(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)


class TokenGroupMatrix:
    """Groups of similar sets with the union of each group's tokens; queries open only groups that can hold a partner.

    A set joins the first group whose leader shares one of a few min-hashes and is similar enough, else it leads a new
    one. The matrix is sparse, token by token: which groups have the token in their union. Adding up the rows of a
    query's tokens bounds its overlap with the members of every group at once.
    """

    HASHES, SIMILAR = 6, 60

    def __init__(self, sets: list[np.ndarray], percent: int = PERCENT):
        self.sets, self.percent = sets, percent
        self.group = np.zeros(len(sets), np.int64)
        leaders: list[int] = []
        by_hash: dict[tuple[int, int], list[int]] = {}
        for i, x in enumerate(sets):
            marks = [(k, int(((x ^ np.uint64(0x9E3779B97F4A7C15 * (k + 1) % 2**64)) * _MIX1).min())) for k in range(self.HASHES)]
            found = next((g for g in dict.fromkeys(g for m in marks for g in by_hash.get(m, ())[:4]) if linked(x, sets[leaders[g]], self.SIMILAR)), None)
            if found is None:
                found = len(leaders)
                leaders.append(i)
                for m in marks:
                    by_hash.setdefault(m, []).append(found)
            self.group[i] = found
        self.groups = len(leaders)
        pairs_token = np.concatenate(sets)
        pairs_group = np.repeat(self.group, [len(x) for x in sets])
        order = np.lexsort((pairs_group, pairs_token))
        pairs_token, pairs_group = pairs_token[order], pairs_group[order]
        keep = np.append(True, (pairs_token[1:] != pairs_token[:-1]) | (pairs_group[1:] != pairs_group[:-1]))
        token, self.has = pairs_token[keep], pairs_group[keep]
        start = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        self.token, self.start = token[start], np.append(start, len(token))
        self.opened = 0

    def qualifying(self, x: np.ndarray) -> list[int]:
        """The groups of which some member could be similar to x."""
        row = np.searchsorted(self.token, x)
        low = self.start[row]
        n = self.start[row + 1] - low
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        return np.flatnonzero(np.bincount(self.has[at], minlength=self.groups) >= least_shared(len(x), self.percent)).tolist()

    def clusters(self, labels: list | None = None, asked: list[bool] | None = None) -> Clusters:
        """All sets joined along all links of which one side is asked (else: all). Sets of equal labels are joined from the
        start. A set is not compared with a cluster that it already belongs to."""
        found = Clusters(len(self.sets))
        begun: dict = {}
        for i, label in enumerate(labels or ()):
            found.unite(i, begun.setdefault(label, i))
        #: per group, the sets seen so far by cluster; roots are brought up to date when the group is opened
        seen: list[dict[int, list[int]]] = [{} for _ in range(self.groups)]
        for i in sorted(range(len(self.sets)), key=lambda i: asked is None or asked[i]):
            for g in self.qualifying(self.sets[i]) if asked is None or asked[i] else ():
                if not seen[g]:
                    continue
                self.opened += 1
                now: dict[int, list[int]] = {}
                for r, own in seen[g].items():
                    r = found.root(r)
                    if r in now:
                        now[r] = now[r] + own if len(now[r]) >= len(own) else own + now[r]
                    else:
                        now[r] = own
                seen[g] = now
                for r, own in now.items():
                    if found.root(r) != found.root(i) and any(linked(self.sets[i], self.sets[j], self.percent) for j in own):
                        found.unite(i, r)
            seen[self.group[i]].setdefault(i, []).append(i)
        return found


# --- the parts of the job --------------------------------------------------------------------------------------------


@frugal
def _frequent(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All tokens with the number of documents that have them, some millions of tokens at a time."""
    held: list[np.ndarray] = []
    size = 0

    def flush() -> pa.RecordBatch:
        tokens, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(n)], names=["token", "n"])

    for part in parts:
        for texts in slices(part.column(0), 1 << 20):
            held += shingle_sets(texts)
            size += sum(map(len, held[-len(texts) :]))
            if size > 2_000_000:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def _in_order(tokens: np.ndarray, span: np.ndarray, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """One order for all sets: long shingles first, which are rare as long words are, then by hash; but those known to be
    frequent come last, by count."""
    tokens = tokens[np.argsort(-span, kind="stable")]
    if not len(frequent):
        return tokens
    at = np.searchsorted(frequent, tokens)
    at[at == len(frequent)] = 0
    hit = frequent[at] == tokens
    if not hit.any():
        return tokens
    late, order = tokens[hit], rank[at[hit]]
    return np.concatenate([tokens[~hit], late[np.lexsort((late, order))]])


def _prefix_rows(held, words: int, percent: int):
    @frugal
    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, rank = held.value
        for part in parts:
            ids, at = part.column(0), 0
            for texts in slices(part.column(1), 1 << 20):
                n, need, keys, prefixes = [], [], [], []
                for s, span in sized_shingle_sets(texts, words):
                    n.append(len(s))
                    keys.append(xxhash.xxh3_128_digest(s.tobytes()))
                    need.append(must_meet(len(s), percent))
                    prefixes.append(_in_order(s, span, frequent, rank)[: len(s) - least_shared(len(s), percent) + need[-1]].view(np.int64))
                lists = pa.ListArray.from_arrays(np.cumsum([0, *map(len, prefixes)]).astype(np.int32), pa.array(np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)))
                yield pa.RecordBatch.from_arrays([ids.slice(at, len(texts)), part.column(2).slice(at, len(texts)), pa.array(n, pa.int64()), pa.array(need, pa.int64()), pa.array(keys, pa.binary()), lists], names=["doc_id", "text_key", "n", "need", "set_key", "prefix"])
                at += len(texts)

    return rows


def _meetings(percent: int):
    """From rows (token, group, need, n) sorted by token and group: the pairs of different groups that share a token and
    have sets of sizes that can be similar."""

    def pairs(token, group, need, n):
        if not len(token):
            return
        keep = np.flatnonzero(np.append(True, (token[1:] != token[:-1]) | (group[1:] != group[:-1])))
        need, least, most = np.minimum.reduceat(need, keep), np.minimum.reduceat(n, keep), np.maximum.reduceat(n, keep)
        token, group = token[keep], group[keep]
        start = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
        sizes = np.diff(np.append(start, len(token)))

        def batch(x, y, needs):
            return pa.RecordBatch.from_arrays([pa.array(group[x]), pa.array(group[y]), pa.array(needs)], names=["u", "v", "need"])

        for size in np.unique(sizes[sizes > 1]).tolist():
            if size > MOST_PAIRED:
                # all meet the first one, however many tokens they share
                for s in start[sizes == size].tolist():
                    yield batch(np.full(size - 1, s), np.arange(s + 1, s + size), np.zeros(size - 1, np.int64))
                continue
            first, second = np.triu_indices(size, 1)
            runs = start[sizes == size]
            step = max(1, 400_000 // len(first))
            for r in range(0, len(runs), step):
                own = runs[r : r + step, None]
                x, y = (own + first).ravel(), (own + second).ravel()
                ok = (100 * most[x] >= percent * least[y]) & (100 * most[y] >= percent * least[x])
                x, y = x[ok], y[ok]
                if len(x):
                    yield batch(x, y, np.minimum(need[x], need[y]))

    @frugal
    def meetings(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size = 0
        for part in parts:
            columns = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in part.columns]
            token = columns[0]
            if not len(token):
                continue
            cut = int(np.searchsorted(token, token[-1]))  # the last token may go on in the next batch
            if size + cut >= PAIRED_ROWS and (cut or held[-1][0][-1] != token[0]):
                yield from pairs(*(np.concatenate(c) for c in zip(*held, [c[:cut] for c in columns])))
                held, size, columns = [], 0, [c[cut:] for c in columns]
            held.append(columns)
            size += len(columns[0])
        if held:
            yield from pairs(*(np.concatenate(c) for c in zip(*held)))

    return meetings


def _sets(words: int):
    """From rows (task, node, label, asked, text): the same with the set as payload, sorted 64-bit tokens."""

    @frugal
    def sets(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given: set[tuple[int, bytes]] = set()
        for part in parts:
            at = 0
            for texts in slices(part.column(4), 1 << 20):
                piece, rows = part.slice(at, len(texts)), []
                at += len(texts)
                for task, node, label, asked, s in zip(*(piece.column(k).to_pylist() for k in range(4)), shingle_sets(texts, words)):
                    # repeated rows give one set; a row of another text with the same key, if there ever is one, none
                    if (task, node) not in given and xxhash.xxh3_128_digest(s.tobytes()) == node:
                        given.add((task, node))
                        rows.append((task, node, label, asked, s.tobytes()))
                if rows:
                    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.bool_(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["task", "node", "label", "asked", "payload"])

    return sets


def _matched(percent: int):
    def solve(payloads: list[bytes], labels: list[bytes], asked: list[bool]) -> list[bytes]:
        if len(payloads) == 1:
            return labels
        found = TokenGroupMatrix([np.frombuffer(p, np.uint64) for p in payloads], percent).clusters(labels, asked)
        least: dict[int, bytes] = {}
        for i, label in enumerate(labels):
            r = found.root(i)
            least[r] = min(least.get(r, label), label)
        return [least[found.root(i)] for i in range(len(labels))]

    return solve


def _frequent_tokens(docs: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(token, count) of the frequent tokens, sorted by token: all counts above a bound that at most ``most`` tokens reach. A
    share of the texts is counted, exactly: a token that is rare in every part of a large table shows too."""
    counted = docs.where(F.pmod(F.xxhash64("text"), F.lit(COUNTED_OF)) == 0).select("text")
    often = stored(counted.mapInArrow(_frequent, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT), "ngram-often")
    # counts by eighths of a power of two: a few hundred rows
    step = F.floor(F.log2("n") * 8).cast("int")
    bound, total = 1 << 30, 0
    for r in often.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        if (total := total + r["count"]) > most:
            break
        bound = r["step"]
    rows = often.where(step >= bound).toArrow()
    token, n = rows.column("token").to_numpy().view(np.uint64), rows.column("n").to_numpy()
    order = np.argsort(token)
    return token[order], n[order]


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, task_tokens: int = TASK_TOKENS, with_places: bool = False) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the least doc_id reachable over links, itself included).

    Two documents link when 100 * intersection >= percent * union of their distinct word shingles. Equal sets are one
    class from the start. A class emits a prefix of its tokens, long ones first, long enough that two linked classes share
    ``must_meet`` tokens of it; classes with the same first token are a group, and groups that share so many tokens are
    candidates, matched by the token-group matrix; candidates beyond one task in blocks (``joined_sets``). All of this
    loses no link.

    Every row gets one row, also rows that share an id, with any texts. Null and empty texts have no shingles and link
    with nothing; rows of equal text link; other columns are not looked at; an empty table gives an empty result. The id
    has to be a 64-bit integer or text that reads as one; others become null. A component takes the least id that is not
    null; one of null ids alone has a null component. ``with_places`` adds text_key (a hash of the text) and stays: whether
    the row's id and text are the first of its component, by id, nulls last, then by text_key; true of rows without shingles.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).try_cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    held = spark.sparkContext.broadcast(_frequent_tokens(docs, MOST_FREQUENT))
    made = stored(docs.withColumn("text_key", F.xxhash64("text")).mapInArrow(_prefix_rows(held, words, percent), "doc_id long, text_key long, n long, need long, set_key binary, prefix array<long>"), "ngram-sets")

    classes = stored(
        made.where("n > 0").groupBy("set_key")
        .agg(F.min("doc_id").alias("rep"), F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")).alias("place"), F.first("n").alias("n"), F.first("need").alias("need"), F.first("prefix").alias("prefix"))
        .withColumn("grp", F.col("prefix")[0]),
        "ngram-classes",
    )
    met = (
        classes.where(F.col("n") * 100 >= (F.col("n") + 1) * percent)  # smaller sets link with equal ones only
        .select(F.explode("prefix").alias("token"), "grp", "need", "n")
        .repartition("token")
        .sortWithinPartitions("token", "grp")
        .mapInArrow(_meetings(percent), "u long, v long, need long")
        .groupBy("u", "v")
        .agg(F.count("*").alias("n"), F.min("need").alias("need"))
        .where("n >= need")
    )
    met = stored(met, "ngram-met")
    roots = stored(connected(met.select("u", "v"), "ngram-groups"), "ngram-roots")
    groups = classes.groupBy("grp").agg(F.count("*").alias("sets")).join(roots.withColumnRenamed("node", "grp"), "grp", "left")
    groups = groups.where("sets > 1 or root is not null").select("grp", F.coalesce("root", "grp").alias("part"))
    wanted = stored(classes.select("set_key", "place", "grp", "n").join(groups, "grp"), "ngram-wanted")
    keyed = docs.withColumn("text_key", F.xxhash64("text"))

    def fetch(tasks: DataFrame) -> DataFrame:
        at = tasks.join(wanted.select(F.col("set_key").alias("node"), F.col("place.doc_id").alias("at_id"), F.col("place.text_key").alias("at_key")), "node")
        rows = maybe_among(keyed, "text_key", at.select("at_key")).join(at, (F.col("text_key") == F.col("at_key")) & F.col("doc_id").eqNullSafe(F.col("at_id"))).select("task", "node", "label", "asked", "text")
        return rows.mapInArrow(_sets(words), "task long, node binary, label binary, asked boolean, payload binary")

    def unsettled(nodes: DataFrame) -> DataFrame:
        of = nodes.join(wanted.select(F.col("set_key").alias("node"), "grp"), "node")
        labels = of.select("grp", "label").distinct()
        apart = met.where("need > 0").join(labels.toDF("u", "lu"), "u").join(labels.toDF("v", "lv"), "v").where("lu <> lv")
        open_groups = apart.select(F.col("u").alias("grp")).union(apart.select("v")).union(labels.groupBy("grp").count().where("count > 1").select("grp"))
        # groups that were put together without counting what they share may link with any that the same one holds together
        fused = met.where("need = 0")
        stars = fused.select(F.col("u").alias("star"), F.col("u").alias("grp")).union(fused.select("u", "v")).distinct()
        open_stars = stars.join(labels, "grp").groupBy("star").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
        open_groups = open_groups.union(stars.join(open_stars, "star").select("grp"))
        return of.join(open_groups.distinct(), "grp").select("node")

    size = F.greatest(F.col("n") / F.lit(float(task_tokens)), F.lit(1.0 / TASK_SETS))
    joined = stored(joined_sets(wanted.select(F.col("set_key").alias("node"), "part", size.alias("size")), fetch, _matched(percent), "ngram", unsettled), "ngram-joined")
    of = classes.select("set_key", "rep", "place").join(joined.withColumnRenamed("node", "set_key"), "set_key")
    least = of.join(of.groupBy("root").agg(F.min("rep").alias("least"), F.min("place").alias("least_place")), "root").select("set_key", "least", "least_place")
    reps = classes.select("set_key", "rep", "place").join(least, "set_key", "left")
    reps = reps.select("set_key", F.coalesce("least", "rep").alias("component_id"), F.coalesce("least_place", "place").alias("at"))
    out = made.select("doc_id", "text_key", F.col("n").alias("n_shingles"), "set_key").join(reps, "set_key", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    stays = (F.col("n_shingles") == 0) | (F.col("at.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("at.text_key") == F.col("text_key")))
    return out.select("doc_id", "n_shingles", component, *(["text_key", stays.alias("stays")] if with_places else []))
