"""Line deduplication by a log-template tree of fixed depth.

A line goes down the tree by its number of tokens and its first tokens to a leaf.
Tokens with a digit are variable fields, unless the line is mostly such. Below the leaf, a token that few contexts of
the leaf have at its place is variable too. What stays constant is the line's template,
if it is most of the line; else the line is its own template. A template that recurs in
enough documents is boilerplate: it keeps its first line, and every other line of it goes.

Documents count only with surroundings of their own: other lines before and after, or a
text that is no near copy of the others (SimHash, four bits). Copies of a document repeat
their lines in the same surroundings and share a fingerprint, so a copied document does
not turn its own text into templates. The inner lines of a block have the same neighbours
everywhere; they count by the fingerprints of the documents. A line of more than fifty
words recurs as it is from the second document that is unlike the first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm import simhash
from tripmill.llm.common import keep, lean, ship, whole
from tripmill.llm.components import components

#: Tokens that lead from the root to a leaf, below the number of tokens.
LEAD = 3
#: Share of constant tokens that a template needs.
CONSTANT = 0.8
#: Documents, each with surroundings of its own, that make a template recur.
RECURS = 5
#: Words from which a line recurs as it is from the second unlike document on.
LONG = 51
#: Bits in which the fingerprints of unlike documents differ at least; near copies differ in fewer.
UNLIKE_BITS = 13
#: Rows of 8 bytes, or bytes of arrays, up to which a side of a join is sent to all tasks.
SENT_ROWS, SENT_BYTES = 1 << 21, 1 << 26
FIELD = "<*>"
_NUMBER = regex.compile(r"\p{N}")


def masked(line: str) -> str:
    """The line with single spaces, and tokens with a digit as fields if they are few enough.

    A line that is mostly data has no template: it can recur as it is only.
    """
    tokens = line.split()
    if _NUMBER.search(line):
        fields = [FIELD if _NUMBER.search(t) else t for t in tokens]
        if len(tokens) - fields.count(FIELD) >= CONSTANT * len(tokens):
            tokens = fields
    return " ".join(tokens)


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def leaf_of(form: str) -> int:
    """The leaf that number and leading tokens of a masked line lead to."""
    return _hash(f"{form.count(' ')} {' '.join(form.split(' ', LEAD)[:LEAD])}")


def text_lines(text: str) -> list[tuple[int, str]]:
    """Number and masked form of the lines that are not blank."""
    return [(i, m) for i, line in enumerate(text.split("\n")) if (m := masked(line))]


_NARROW = "text_hash long, line int, leaf long, hash long, context long, long boolean"


@lean
def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every line of the rows (doc_id, text_hash, text) as hashes."""
    for batch in batches:
        docs, counts = batch.column(0), []
        columns: list[list] = [[], [], [], [], [], []]
        for key, text in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
            found = text_lines(text.as_py())
            hashes = [_hash(m) for _, m in found]
            around = [0, *hashes, 0]
            counts.append(len(found))
            columns[0].extend([key] * len(found))
            columns[1].extend(i for i, _ in found)
            columns[2].extend(leaf_of(m) for _, m in found)
            columns[3].extend(hashes)
            columns[4].extend(
                _hash(f"{a} {b}") for a, b in zip(around[:-2], around[2:], strict=True)
            )
            columns[5].extend(m.count(" ") + 1 >= LONG for _, m in found)
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
        owners = docs.take(pa.array(np.repeat(np.arange(len(docs)), counts)))
        yield pa.RecordBatch.from_arrays(
            [owners, *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
            ["doc_id", "text_hash", "line", "leaf", "hash", "context", "long"],
        )


def _forms_in(leaves) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(leaf, hash, form) of the lines of the rows (text), each once in a batch.

    ``leaves`` is a broadcast array of the leaves that count, in order, or None for all.
    """

    @lean
    def forms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = list({m for text in batch.column(0) for _, m in text_lines(text.as_py())})
            leaf = np.fromiter(map(leaf_of, forms), np.int64, len(forms))
            if leaves is not None:
                among = leaves.value
                place = np.minimum(np.searchsorted(among, leaf), max(len(among) - 1, 0))
                here = among[place] == leaf if len(among) else np.zeros(len(leaf), bool)
                forms, leaf = [forms[i] for i in np.flatnonzero(here)], leaf[here]
            yield pa.RecordBatch.from_arrays(
                [pa.array(leaf), pa.array([_hash(m) for m in forms], pa.int64()), pa.array(forms, pa.string())],
                ["leaf", "hash", "form"],
            )

    return forms_of


def place_lines(docs: DataFrame) -> DataFrame:
    """One narrow row for each line that is not blank: its document, leaf, hash and context."""
    ship(docs.sparkSession)
    rows = docs.select("doc_id", _text_hash(F.col("text")), whole(F.col("text")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_placed, f"doc_id {kind}, {_NARROW}")


def that_can_recur(lines: DataFrame) -> DataFrame:
    """The lines of leaves with enough rows, and long lines of leaves with two.

    No other line reaches a count that makes it recur, whatever its surroundings.
    """
    leaves = lines.groupBy("leaf").agg(F.count("*").alias("n"), F.max("long").alias("long"))
    enough = (F.col("n") >= RECURS) | (F.col("long") & (F.col("n") > 1))
    leaves = keep(leaves.filter(enough).select("leaf"), "leaves")
    return lines.join(sent(leaves), "leaf", "left_semi")


def sent(rows: DataFrame) -> DataFrame:
    """A written table of one long: broadcast if it is small, else joined as Spark sees fit."""
    return F.broadcast(rows) if rows.count() <= SENT_ROWS else rows


def _text_hash(text: Column) -> Column:
    return F.xxhash64(whole(text)).alias("text_hash")


def contexts(lines: DataFrame) -> DataFrame:
    """(leaf, hash, context, rows, first): each line in each of its surroundings."""
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "line"))
    return lines.groupBy("leaf", "hash", "context", "long").agg(
        F.count("*").alias("rows"), first.alias("first")
    )


def unlike(docs: DataFrame, lines: DataFrame, places: DataFrame) -> DataFrame:
    """(hash, root): the groups of near copies that hold a line, one row each.

    Only lines that repeat in the same surroundings, in leaves of enough rows, and long
    ones that repeat at all: all other lines have as many contexts as rows, or too few
    rows to recur. Texts without such a line are not fingerprinted, and texts are only
    exchanged where their hashes are too many to be sent.
    """
    by_hash = places.groupBy("leaf", "hash", "long").agg(
        F.sum("rows").alias("rows"), F.count("*").alias("n")
    )
    enough = by_hash.groupBy("leaf").agg(F.sum("rows").alias("r")).filter(F.col("r") >= RECURS)
    repeated = by_hash.filter(F.col("rows") > F.col("n")).join(enough, "leaf", "left_semi")
    long = by_hash.filter(F.col("long") & (F.col("rows") > 1))
    hashes = keep(repeated.select("hash").union(long.select("hash")).distinct(), "repeated")
    holders = lines.join(sent(hashes), "hash", "left_semi")
    holders = keep(holders.select("hash", "text_hash").distinct(), "holders")
    holding = keep(holders.select("text_hash").distinct(), "holding")
    texts = docs.select(_text_hash(F.col("text")), whole(F.col("text")).alias("text"))
    texts = texts.join(sent(holding), "text_hash", "left_semi")
    prints = simhash.fingerprints(texts.select(F.col("text_hash").alias("doc_id"), "text"))
    prints = keep(prints.distinct(), "prints")
    roots = components(simhash.linked(prints.select("fp").distinct()))
    rooted = prints.join(roots.select(F.col("u").alias("fp"), F.col("v").alias("root")), "fp", "left")
    rooted = rooted.select(F.col("doc_id").alias("text_hash"), F.coalesce("root", "fp").alias("root"))
    return holders.join(rooted, "text_hash").select("hash", "root").distinct()


def long_repeats(places: DataFrame, groups: DataFrame) -> DataFrame:
    """(hash) of the long lines that two unlike documents hold.

    Groups of near copies are unlike if their lowest fingerprints differ in many bits.
    Lines of ``RECURS`` groups recur anyway, so fewer than that are compared for a line.
    """
    long = places.filter("long").select("hash").distinct()
    few = groups.groupBy("hash").agg(F.count("*").alias("g"))
    few = few.filter((F.col("g") > 1) & (F.col("g") < RECURS)).join(long, "hash", "left_semi")
    held = groups.join(few.select("hash"), "hash", "left_semi")
    other = held.select("hash", F.col("root").alias("other"))
    apart = F.bit_count(F.col("root").bitwiseXOR(F.col("other"))) >= UNLIKE_BITS
    return held.join(other, "hash").filter(apart).select("hash").distinct()


def templates(docs: DataFrame, places: DataFrame, groups: DataFrame) -> DataFrame:
    """(hash, template) of the lines whose template is more general than themselves.

    A line weighs as many documents as it has contexts, or groups of near copies if those
    are more. Only leaves with several different lines of enough weight are looked into.
    All counting is by hash aggregation, combined before the exchange.
    """
    weights = (
        places.groupBy("leaf", "hash")
        .agg(F.count("*").alias("n"))
        .join(groups.groupBy("hash").agg(F.count("*").alias("g")), "hash", "left")
        .select("leaf", "hash", F.greatest("n", F.coalesce("g", F.lit(0))).alias("weight"))
    )
    crowded = keep(
        weights.groupBy("leaf")
        .agg(F.sum("weight").alias("n"), F.min("hash").alias("low"), F.max("hash").alias("high"))
        .filter((F.col("n") >= RECURS) & (F.col("low") != F.col("high")))
        .select("leaf"),
        "crowded",
    )
    among = None
    if crowded.count() <= SENT_ROWS:
        leaves = crowded.toArrow().column("leaf").to_numpy()
        among = docs.sparkSession.sparkContext.broadcast(np.sort(leaves))
    forms = (
        docs.select(whole(F.col("text")).alias("text"))
        .mapInArrow(_forms_in(among), "leaf long, hash long, form string")
        .join(sent(crowded), "leaf", "left_semi")
        .groupBy("leaf", "hash")
        .agg(F.min("form").alias("form"))
    )
    tokens = forms.join(weights.select("hash", "weight"), "hash").select(
        "leaf", "hash", "weight", F.posexplode(F.split("form", " ")).alias("place", "token")
    )
    tokens = keep(tokens, "line-tokens")
    common = (
        tokens.groupBy("leaf", "place", "token")
        .agg(F.sum("weight").alias("seen"))
        .filter((F.col("seen") >= RECURS) | (F.col("place") < LEAD))
        .select("leaf", "place", "token", F.lit(True).alias("constant"))
    )
    tree = tokens.join(common, ["leaf", "place", "token"], "left")
    field = F.when(F.col("constant"), F.col("token")).otherwise(F.lit(FIELD))
    general = (
        tree.groupBy("leaf", "hash")
        .agg(
            F.sort_array(F.collect_list(F.struct("place", field.alias("token")))).alias("tokens"),
            F.count_if(F.col("constant") & (F.col("token") != FIELD)).alias("constants"),
        )
        .filter(
            (F.col("constants") < F.size("tokens"))
            & (F.col("constants") >= CONSTANT * F.size("tokens"))
        )
    )
    return general.select("hash", F.xxhash64("leaf", "tokens.token").alias("template"))


def recurring_lines(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(hash, template, first) of all lines of recurring templates.

    ``first`` is the smallest (doc_id, text_hash, line) of the template; rows without a
    doc_id come after all others.
    """
    places = keep(contexts(lines), "places")
    groups = keep(unlike(docs, lines, places), "groups")
    found = keep(templates(docs, places, groups), "general")
    own = F.coalesce("template", F.xxhash64("hash")).alias("template")
    named = places.join(found, "hash", "left").select("hash", own, "context", "first")
    around = (
        named.groupBy("template", "context")
        .agg(F.min("first").alias("first"))
        .groupBy("template", "first.doc_id", "first.text_hash")
        .agg(F.min("first").alias("first"))
        .groupBy("template")
        .agg(F.count("*").alias("n"), F.min("first").alias("first"))
    )
    apart = (
        groups.join(found, "hash", "left")
        .select(own, "root")
        .distinct()
        .groupBy("template")
        .agg(F.count("*").alias("g"))
        .filter(F.col("g") >= RECURS)
    )
    long = long_repeats(places, groups).join(found, "hash", "left").select(own)
    long = long.distinct().withColumn("long", F.lit(True))
    recurs = (
        around.join(apart, "template", "left")
        .join(long, "template", "left")
        .filter((F.col("n") >= RECURS) | F.col("g").isNotNull() | F.col("long"))
        .select("template", "first")
    )
    return named.select("hash", "template").distinct().join(recurs, "template")


def dropped_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, dropped) with the numbers of the lines that go, in order, for rows with any."""
    lines = keep(place_lines(docs), "lines")
    lines = keep(that_can_recur(lines), "candidate-lines")
    recurring = keep(recurring_lines(docs, lines), "templates")
    here = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash", "line")
    gone = lines.join(recurring, "hash").filter(~here.eqNullSafe(F.col("first")))
    dropped = F.array_sort(F.collect_set("line")).alias("dropped")
    return gone.groupBy("doc_id", "text_hash").agg(dropped)


def _with_dropped(docs: DataFrame) -> DataFrame:
    """Columns d (the row as it is) and dropped (null if nothing goes)."""
    whole_row = docs.select(F.struct("*").alias("d"))
    gone = keep(dropped_lines(docs), "dropped")
    size = gone.agg(F.sum(F.size("dropped") * 8 + 64)).first()[0] or 0
    gone = (F.broadcast(gone) if size <= SENT_BYTES else gone).alias("g")
    same = F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (
        _text_hash(F.col("d.text")) == F.col("g.text_hash")
    )
    return whole_row.join(gone, same, "left").select("d", "dropped")


def kept_text(text: Column, dropped: Column) -> Column:
    """The text without the lines of the given numbers (from 0, in order).

    What lies between two dropped lines is taken as a whole, so the cost grows with the
    text and not with text times dropped lines.
    """

    def between(found: Column) -> Column:
        starts = F.concat(F.array(F.lit(0)), F.transform(dropped, lambda i: i + 1))
        ends = F.concat(dropped, F.array(F.size(found)))
        spans = F.arrays_zip(starts.alias("a"), ends.alias("b"))
        return F.flatten(F.transform(spans, lambda s: F.slice(found, s["a"] + 1, s["b"] - s["a"])))

    # The lines are bound to a variable: split once a text.
    rest = F.transform(F.array(F.split(text, "\n")), between)[0]
    return F.when(dropped.isNull(), text).otherwise(F.array_join(rest, "\n"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines (not blank), n_dropped and text (what is left) of every row.

    A null text has no lines and stays null; blank lines never go. Rows alike in doc_id
    and text are one document, of which every row keeps the same lines. An empty table
    gives no rows. Columns other than doc_id and text are not read.
    """
    narrow = docs.select("doc_id", "text")
    lines = F.filter(F.split(whole(F.col("d.text")), "\n"), lambda x: F.trim(x) != "")
    return _with_dropped(narrow).select(
        "d.doc_id",
        F.size(lines).alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).alias("n_dropped"),
        kept_text(F.col("d.text"), F.col("dropped")).alias("text"),
    )


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without recurring lines, and without rows left with none.

    All columns stay; n_chars, where there is one, counts the new text. A text that was
    blank or null before is not touched.
    """
    kept = _with_dropped(docs).withColumn("left", kept_text(F.col("d.text"), F.col("dropped")))
    kept = kept.filter(F.col("dropped").isNull() | (F.trim("left") != ""))
    changed = {"text": F.col("left")}
    if "n_chars" in docs.columns:
        n = F.length("left").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.col("dropped").isNull(), F.col("d.n_chars")).otherwise(n)
    return kept.select(*(changed.get(c, F.col(f"d.`{c}`")).alias(c) for c in docs.columns))
