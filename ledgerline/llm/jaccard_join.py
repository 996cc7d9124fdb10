"""N-gram Jaccard join with several global token orders.

A document's tokens are its distinct word shingles. Documents with equal token sets
form a class, and only classes are compared. Under any total order of all tokens,
two sets that reach the threshold share a token among their first ones (the prefix),
and at their first common token enough of both sets must lie ahead. So candidates

* meet in the groups of one order's prefix tokens, each at a position that still
  allows the overlap that their sizes call for,
* and must share prefix tokens under every further order too; the filters are
  intersected before any set is counted.

All orders put tokens seen often last (by the logarithm of a count over the whole
corpus) and differ in how they order tokens within a frequency class.

In each group every class is first
paired with one hub: the class with most copies, then the one with fewest rarer
tokens, which is the most central of its variants. Verified links give labels, and
only classes of different labels in one group still have to be compared: outliers
against the rest of the group, limited by size and position only, so m classes of one
group that no hub links still give up to about m * m / 2 pairs. Components follow from all verified links, so no link
between different texts is lost; links inside a labelled cluster are not listed.

Class ids are 64-bit hashes of the token sets.

Defined results: null and blank texts have no tokens and link with nothing; a text
with fewer words than a shingle is one token; repeated rows are copies; a component
without any id has a null id; an empty table gives an empty table; other input
columns are not used by the join and are kept by :func:`keep_one_of_each`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from ledgerline.llm.columns import free_name, text_bytes
from ledgerline.llm.graph import connected_components
from ledgerline.llm.words import SPACED, mix, window_hashes, word_hashes
from ledgerline.sources.sinks import materialize

#: Tokens a task gathers before it counts them or drops copies among its classes.
CHUNK = 1 << 20
#: Most tokens in the table of frequent ones (12 bytes each) that every task holds.
FREQUENT = 200_000
#: Candidate classes up to this number (24 bytes each) are broadcast to pick their texts; more are joined by shuffle.
BROADCAST_CLASSES = 500_000
#: Groups of frequent tokens are dealt over parts of about this many classes.
GROUP_PART = 2048


@dataclass(frozen=True)
class JoinSpec:
    """Words in a shingle, least similarity in percent, seeds of the token orders (the first one forms the groups)."""

    words: int = 4
    percent: int = 85
    orders: tuple[int, ...] = (11, 23, 47)

    def prefix(self, n: int) -> int:
        """Tokens of a set of ``n`` of which one at least is shared with any set it links to."""
        return n - -(-self.percent * n // 100) + 1

    def overlap(self, a: Column, b: Column) -> Column:
        """Common tokens that sets of these sizes need."""
        return F.ceil(F.lit(self.percent) * (a + b) / F.lit(100 + self.percent))


def token_set(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text, A-Z lower-cased."""
    hashes = word_hashes(text.lower(), SPACED)
    if not len(hashes):
        return np.zeros(0, np.uint64)
    if len(hashes) < words:
        return mix(window_hashes(hashes, len(hashes)) + np.uint64(len(hashes)))
    return np.unique(window_hashes(hashes, words))


def class_id(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


class Frequency:
    """Logarithms of the counts of frequent tokens; 0 for all others."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        order = np.argsort(tokens)
        self.tokens, self.counts = tokens[order], counts[order]

    def count(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.tokens):
            return np.zeros(len(tokens), np.int64)
        at = np.searchsorted(self.tokens, tokens)
        at[at == len(self.tokens)] = 0
        return np.where(self.tokens[at] == tokens, self.counts[at], 0)

    def prefix(self, tokens: np.ndarray, size: int, seed: int) -> np.ndarray:
        """The first ``size`` tokens under the order of this seed."""
        level = np.log2(self.count(tokens) + 1.0).astype(np.int64)
        return tokens[np.lexsort((mix(tokens ^ np.uint64(seed)), level))[:size]]


_SURVEY = "key1 bigint, key2 bigint, class bigint, n bigint, token bigint, seen bigint"
_SURVEY_COLUMNS = ["key1", "key2", "class", "n", "token", "seen", "id"]


def _survey_rows(spec: JoinSpec):
    """For each document its class; and the tokens that classes of one chunk share, with their counts."""
    def counted(sets: dict[int, np.ndarray], id_type: pa.DataType) -> pa.RecordBatch:
        tokens, seen = np.unique(np.concatenate(list(sets.values())), return_counts=True)
        often = seen > 1
        nothing = pa.nulls(int(often.sum()), pa.int64())
        return pa.RecordBatch.from_arrays([nothing, nothing, nothing, nothing, pa.array(tokens[often].view(np.int64)),
                                           pa.array(seen[often]), pa.nulls(len(nothing), id_type)], _SURVEY_COLUMNS)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, size = {}, 0
        for part in batches:
            classes, sizes = [], []
            for text in text_bytes(part.column("text")):
                tokens = token_set(text, spec.words)
                sizes.append(len(tokens))
                classes.append(class_id(tokens) if len(tokens) else None)
                if len(tokens) and classes[-1] not in sets:
                    sets[classes[-1]] = tokens
                    size += len(tokens)
                if size >= CHUNK:
                    yield counted(sets, part.column("id").type)
                    sets, size = {}, 0
            nothing = pa.nulls(part.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("key1"), part.column("key2"), pa.array(classes, pa.int64()), pa.array(sizes, pa.int64()),
                 nothing, nothing, part.column("id")], _SURVEY_COLUMNS)
            id_type = part.column("id").type
        if sets:
            yield counted(sets, id_type)
    return rows


_INDEX = "token bigint, parts int, part int, class bigint, n int, place int, copies int"


def _index_rows(spec: JoinSpec, frequency):
    """The prefix tokens of each class under the first order; classes of one chunk once, with their copies."""
    def flush(sets: dict[int, list]) -> pa.RecordBatch:
        lengths = [len(prefix) for prefix, _, _ in sets.values()]
        tokens = np.concatenate([prefix for prefix, _, _ in sets.values()])
        classes = np.repeat(np.fromiter(sets, np.int64, len(sets)), lengths)
        parts = np.maximum(1, -(-frequency.value.count(tokens) // GROUP_PART))
        columns = [tokens.view(np.int64), parts.astype(np.int32), (classes % parts).astype(np.int32), classes,
                   np.repeat([size for _, size, _ in sets.values()], lengths).astype(np.int32),
                   np.concatenate([np.arange(k, dtype=np.int32) for k in lengths]),
                   np.repeat([many for _, _, many in sets.values()], lengths).astype(np.int32)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "parts", "part", "class", "n", "place", "copies"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets, size = {}, 0
        for batch in batches:
            for text in text_bytes(batch.column("text")):
                tokens = token_set(text, spec.words)
                if not len(tokens):
                    continue
                c = class_id(tokens)
                if c in sets:
                    sets[c][2] += 1
                    continue
                prefix = frequency.value.prefix(tokens, spec.prefix(len(tokens)), spec.orders[0])
                sets[c] = [prefix, len(tokens), 1]
                size += len(prefix)
                if size >= CHUNK:
                    yield flush(sets)
                    sets, size = {}, 0
        if sets:
            yield flush(sets)
    return rows


@dataclass
class _Corpus:
    """What the steps share: the documents by key, the members of classes, the frequent tokens."""

    docs: DataFrame
    members: DataFrame
    spec: JoinSpec
    frequency: object


def _keys(df: DataFrame, id_col: str, text_col: str) -> tuple[Column, Column]:
    """Two numbers that tell rows of different id or text apart."""
    id_, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    number = id_.cast("long") if isinstance(df.schema[id_col].dataType, IntegralType) else F.xxhash64(id_)
    return F.coalesce(number, F.lit(-1).cast("long")), F.xxhash64(id_, text)


def _survey(docs: DataFrame, spec: JoinSpec) -> _Corpus:
    schema = f"{_SURVEY}, id {docs.schema['id'].dataType.simpleString()}"
    survey = materialize(docs.mapInArrow(_survey_rows(spec), schema), "survey")
    often = (survey.where("token IS NOT NULL").groupBy("token").agg(F.sum("seen").alias("seen"))
             .orderBy(F.desc("seen"), "token").limit(FREQUENT).toArrow())
    frequency = Frequency(often["token"].to_numpy().view(np.uint64), often["seen"].to_numpy().astype(np.int64))
    members = survey.where("n IS NOT NULL").select("id", "key1", "key2", "class", "n")
    return _Corpus(docs, members, spec, docs.sparkSession.sparkContext.broadcast(frequency))


def _groups(corpus: _Corpus) -> DataFrame:
    """Rows of the prefix groups that hold two classes or more, each row with the hub of its group (or part)."""
    rows = corpus.docs.select("text").mapInArrow(_index_rows(corpus.spec, corpus.frequency), _INDEX)
    group = Window.partitionBy("token", "part")
    rows = rows.withColumns({
        "fewest": F.min("class").over(group), "most": F.max("class").over(group),
        "hub": F.max(F.struct("copies", (-F.col("place")).alias("central"), "class", "n", "place")).over(group)})
    kept = rows.where((F.col("parts") > 1) | (F.col("fewest") != F.col("most"))).drop("fewest", "most")
    return materialize(kept, "groups")


def _fits(spec: JoinSpec, n_a, place_a, n_b, place_b) -> Column:
    """Whether the token at these places can be the first common one of two sets that link."""
    need = spec.overlap(n_a, n_b)
    return (n_a - place_a >= need) & (n_b - place_b >= need)


def _hub_pairs(groups: DataFrame, spec: JoinSpec) -> DataFrame:
    """(a, b): each class with the hub of its group; hubs of the parts of one token with the hub of them all."""
    near = groups.select("class", "n", "place", "hub")
    hubs = groups.where("parts > 1").select("token", "hub").distinct()
    tops = hubs.groupBy("token").agg(F.max("hub").alias("top"))
    far = hubs.join(tops, "token").select(F.col("hub.class").alias("class"), F.col("hub.n").alias("n"),
                                          F.col("hub.place").alias("place"), F.col("top").alias("hub"))
    fits = _fits(spec, F.col("n"), F.col("place"), F.col("hub.n"), F.col("hub.place"))
    pairs = near.unionByName(far).where((F.col("class") != F.col("hub.class")) & fits)
    return pairs.select(F.least("class", "hub.class").alias("a"), F.greatest("class", "hub.class").alias("b")).distinct()


def _texts_of(corpus: _Corpus, pairs: DataFrame) -> DataFrame:
    """(class, text, a prefix for each further order) of the classes in the pairs, from one document of each."""
    wanted = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class"))).distinct()
    first = corpus.members.where("class IS NOT NULL").groupBy("class").agg(F.min(F.struct("key1", "key2")).alias("key"))
    chosen = materialize(first.join(wanted, "class").select("class", "key.key1", "key.key2"), "chosen")
    if chosen.count() <= BROADCAST_CLASSES:
        chosen = F.broadcast(chosen)
    found = corpus.docs.select("key1", "key2", "text").join(chosen, ["key1", "key2"]).select("class", "text").dropDuplicates(["class"])
    spec, frequency = corpus.spec, corpus.frequency

    @F.arrow_udf("array<array<int>>")
    def prefixes(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in column:
            rows = []
            for text in text_bytes(part):
                tokens = token_set(text, spec.words)
                size = spec.prefix(len(tokens))
                rows.append([frequency.value.prefix(tokens, size, seed).astype(np.uint32).view(np.int32)
                             for seed in spec.orders[1:]])
            yield pa.array(rows, pa.list_(pa.list_(pa.int32())))

    return materialize(found.withColumn("prefixes", prefixes("text")), "texts")


def _verified(corpus: _Corpus, pairs: DataFrame) -> DataFrame:
    """The pairs that link: filtered by the prefixes under all further orders, then counted on the whole sets."""
    texts = _texts_of(corpus, pairs)
    filters = texts.select("class", "prefixes")
    both = (pairs.join(filters.select(F.col("class").alias("a"), F.col("prefixes").alias("pa")), "a")
            .join(filters.select(F.col("class").alias("b"), F.col("prefixes").alias("pb")), "b"))
    shared = F.lit(True)
    for i in range(len(corpus.spec.orders) - 1):
        shared = shared & F.arrays_overlap(F.col("pa")[i], F.col("pb")[i])
    left = materialize(both.where(shared).select("a", "b"), "candidates")
    spec = corpus.spec

    @F.arrow_udf("boolean")
    def linked(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kept: dict[bytes, np.ndarray] = {}

        def tokens(text: bytes) -> np.ndarray:
            if text not in kept:
                if len(kept) >= 64:  # pairs of one hub come together
                    kept.clear()
                kept[text] = token_set(text, spec.words)
            return kept[text]

        for one, two in columns:
            found = []
            for x, y in zip(text_bytes(one), text_bytes(two), strict=True):
                s, t = tokens(x), tokens(y)
                common = len(np.intersect1d(s, t, assume_unique=True))
                found.append(100 * common >= spec.percent * (len(s) + len(t) - common))
            yield pa.array(found, pa.bool_())

    content = texts.select("class", "text")
    with_texts = (left.join(content.select(F.col("class").alias("a"), F.col("text").alias("ta")), "a")
                  .join(content.select(F.col("class").alias("b"), F.col("text").alias("tb")), "b"))
    return materialize(with_texts.where(linked("ta", "tb")).select("a", "b"), "links")


def _open_pairs(groups: DataFrame, links: DataFrame, tested: DataFrame, spec: JoinSpec) -> DataFrame:
    """(a, b) that the links so far do not connect and that no step has compared: outliers against their group."""
    label = connected_components(links).select(F.col("node").alias("class"), F.col("root").alias("label"))
    rows = groups.select("token", "class", "n", "place").distinct().join(label, "class", "left")
    rows = materialize(rows.withColumn("label", F.coalesce("label", "class")), "labelled")
    per_label = rows.groupBy("token", "label").agg(F.count(F.lit(1)).alias("many"))
    open_groups = per_label.groupBy("token").agg(
        F.max(F.struct("many", "label")).alias("top"), F.count(F.lit(1)).alias("labels")).where("labels > 1")
    rows = materialize(rows.join(open_groups.select("token", F.col("top.label").alias("main")), "token"), "open-groups")
    one = rows.where("label <> main").select("token", *(F.col(c).alias(f"{c}_1") for c in ("class", "n", "place", "label")))
    two = rows.select("token", "main", *(F.col(c).alias(f"{c}_2") for c in ("class", "n", "place", "label")))
    met = one.join(two, "token").where(
        (F.col("label_1") != F.col("label_2")) & ((F.col("label_2") == F.col("main")) | (F.col("class_1") < F.col("class_2")))
        & _fits(spec, F.col("n_1"), F.col("place_1"), F.col("n_2"), F.col("place_2")))
    pairs = met.select(F.least("class_1", "class_2").alias("a"), F.greatest("class_1", "class_2").alias("b")).distinct()
    return materialize(pairs.join(tested, ["a", "b"], "left_anti"), "open-pairs")


def link_documents(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", spec: JoinSpec | None = None) -> DataFrame:
    """(id, key1, key2, class, n, root): for each row of ``df`` its id and keys, its class, its number of tokens, its component.

    ``class`` and ``root`` are null for texts without tokens.
    """
    spec = spec or JoinSpec()
    key1, key2 = _keys(df, id_col, text_col)
    docs = df.select(F.col(f"`{id_col}`").alias("id"), key1.alias("key1"), key2.alias("key2"), F.col(f"`{text_col}`").alias("text"))
    corpus = _survey(docs, spec)
    groups = _groups(corpus)
    hub_pairs = materialize(_hub_pairs(groups, spec), "hub-pairs")
    links = _verified(corpus, hub_pairs)
    more = _verified(corpus, _open_pairs(groups, links, hub_pairs, spec))
    roots = connected_components(links.unionByName(more)).select(F.col("node").alias("class"), "root")
    return corpus.members.join(roots, "class", "left").select(
        "id", "key1", "key2", "class", "n", F.coalesce("root", "class").alias("root"))


def keep_one_of_each(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", spec: JoinSpec | None = None) -> DataFrame:
    """The rows of ``df`` that stay when one document of each component does (smallest keys); texts without tokens all stay."""
    spec = spec or JoinSpec()
    linked = link_documents(df, text_col, id_col, spec)
    first = linked.where("root IS NOT NULL").groupBy("root").agg(F.min(F.struct("key1", "key2")).alias("key"))
    name1, name2 = free_name(df, "_key1"), free_name(df, "_key2")
    key1, key2 = _keys(df, id_col, text_col)
    wordless = ~F.coalesce(F.col(f"`{text_col}`").rlike(r"[^ \t-\r]"), F.lit(False))
    keyed = df.withColumns({name1: key1, name2: key2})
    chosen = materialize(first.select(F.col("key.key1").alias(name1), F.col("key.key2").alias(name2)), "kept")
    kept = keyed.where(~wordless).join(chosen, [name1, name2], "left_semi").dropDuplicates([name1, name2])
    return kept.drop(name1, name2).unionByName(df.where(wordless))


def component_ids(linked: DataFrame) -> DataFrame:
    """(class, component_id): the smallest id of each class's component."""
    classes = materialize(linked.where("class IS NOT NULL").groupBy("class", "root").agg(F.min("id").alias("id")), "classes")
    smallest = materialize(classes.groupBy("root").agg(F.min("id").alias("component_id")), "smallest")
    return materialize(classes.join(smallest, "root").select("class", "component_id"), "components")


def op9_jaccard_join(documents: DataFrame) -> DataFrame:
    """Set size and component of every document: 4-word shingles, similarity of 85 % or more."""
    linked = materialize(link_documents(documents.select("doc_id", "text")), "linked")
    found = linked.join(component_ids(linked), "class", "left")
    return found.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                        F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"))


OP9_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
shingles AS (
  SELECT DISTINCT r, list_slice(w, i, i + least(4, len(w)) - 1) AS s
  FROM (SELECT r, w, unnest(generate_series(1, len(w) - least(4, len(w)) + 1)) AS i FROM docs WHERE len(w) > 0)),
sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
shared AS (
  SELECT a.r AS r, b.r AS q, count(*) AS same FROM shingles a JOIN shingles b ON a.s = b.s AND a.r < b.r GROUP BY a.r, b.r),
half AS (
  SELECT r, q FROM shared JOIN sizes x USING (r) JOIN (SELECT r AS q, n AS m FROM sizes) y USING (q)
  WHERE 100 * same >= 85 * (n + m - same)),
links AS (SELECT r, q FROM half UNION ALL SELECT q, r FROM half),
reached AS (
  SELECT r, r AS q FROM docs
  UNION
  SELECT reached.r, links.q FROM reached JOIN links ON links.r = reached.q),
smallest AS (SELECT reached.r, min(doc_id) AS component_id FROM reached JOIN docs ON docs.r = reached.q GROUP BY reached.r)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM docs JOIN smallest USING (r) LEFT JOIN sizes USING (r)
"""
