"""Document fingerprints as Merkle trees, in Spark's own expressions only.

A document's sections are parted by empty lines, a section's paragraphs by line feeds. A paragraph
node is the SHA-256 of its text, a section node that of its paragraphs' nodes, and the root that of
its sections' nodes. Cutting loses nothing, so equal roots mean equal texts, and the branches in
which two trees differ locate an edit: equal nodes are aligned from both ends, so what an edit only
moves does not differ.

Below the paragraphs lie marks, 64-bit hashes of their sentences (in pieces of at most 64
characters), which tell how much of two texts is alike. The n-th occurrence of a piece has a mark
of its own, so repetitions count. The likeness of two fingerprints is 2 * common marks / all
marks. It is 1 only for equal roots: texts with the same sentences in another order stay below.

Defined cases: a null text is the empty one; a text of nothing but line feeds has no marks and is
like nothing but itself. The next document of the last one is the first. Rows without an id have
no next document: they are edited with, and compared to, the empty text. If an id is repeated, its
smallest text stands for it as a next document; repeated rows are edited each. A very long text is
one row and is handled by one task. Empty tables give empty results. Other columns of the table are
not read, so they may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbstream.operators.ordering import numbered
from kerbstream.session import materialise

PIECES = r"[^.!?\n]{1,64}[.!?]*|[.!?]+"


# ---- the tree -------------------------------------------------------------------------------

def _node(kind: str, content: Column) -> Column:
    """The kind goes in first, so that no text can pass for a list of nodes."""
    return F.sha2(F.concat(F.lit(kind), content), 256)


def tree(text: Column) -> Column:
    """array<struct<section, paragraphs: array>>: the nodes below the root, from left to right."""
    def section(part: Column) -> Column:
        return F.struct(_paragraphs(part).alias("paragraphs"))

    inner = F.transform(F.split(text, "\n\n"), section)
    return F.transform(inner, lambda s: F.struct(
        _node("s", F.array_join(s["paragraphs"], "")).alias("section"),
        s["paragraphs"].alias("paragraphs")))


def _paragraphs(section: Column) -> Column:
    return F.transform(F.split(section, "\n"), lambda p: _node("p", p))


def root(text: Column) -> Column:
    """The fingerprint: the tree's root, without keeping the tree."""
    sections = F.transform(
        F.split(text, "\n\n"), lambda s: _node("s", F.array_join(_paragraphs(s), "")))
    return _node("d", F.array_join(sections, ""))


def root_of(tree_column: Column) -> Column:
    return _node("d", F.array_join(F.transform(tree_column, lambda s: s["section"]), ""))


def _aligned(a: Column, b: Column, like) -> tuple[Column, Column]:
    """How many nodes are equal at the start of two lists, and at their end beyond that."""
    shorter = F.least(F.size(a), F.size(b))

    def run(x: Column, y: Column) -> Column:
        # Places that one list lacks are null, which is not False.
        unlike = F.array_position(F.zip_with(x, y, like), False)
        return F.when(unlike > 0, unlike - 1).otherwise(shorter).cast("int")

    start = run(a, b)
    return start, F.least(run(F.reverse(a), F.reverse(b)), shorter - start)


def _middle(nodes: Column, start: Column, end: Column) -> Column:
    return F.slice(nodes, start + 1, F.size(nodes) - start - end)


def differing(a: Column, b: Column) -> Column:
    """array<struct<section, paragraph>> (from 0, in ``b``): the branches in which two trees differ.

    Sections that are equal from the start and from the end are the same branches, wherever an
    edit between them has moved them to. What is left is compared place by place, and one goes
    down only where the section nodes differ; there paragraphs are aligned and compared in the
    same way. A paragraph that one tree lacks differs.
    """
    empty = F.array().cast("array<string>")
    start, end = _aligned(a, b, lambda x, y: x["section"] == y["section"])
    pairs = F.zip_with(_middle(a, start, end), _middle(b, start, end), lambda x, y: F.struct(
        (~x["section"].eqNullSafe(y["section"])).alias("unlike"),
        F.coalesce(x["paragraphs"], empty).alias("x"), F.coalesce(y["paragraphs"], empty).alias("y")))
    places = F.transform(pairs, lambda p, i: F.struct((start + i).alias("section"), p.alias("pair")))
    places = F.filter(places, lambda p: p["pair"]["unlike"])
    return F.flatten(F.transform(places, lambda p: _inside(
        p["section"], p["pair"]["x"], p["pair"]["y"])))


def _inside(section: Column, x: Column, y: Column) -> Column:
    """The branches below one pair of sections."""
    start, end = _aligned(x, y, lambda p, q: p == q)
    unlike = F.zip_with(_middle(x, start, end), _middle(y, start, end),
                        lambda p, q: ~p.eqNullSafe(q))
    places = F.transform(unlike, lambda u, i: F.struct(
        section.alias("section"), (start + i).alias("paragraph"), u.alias("unlike")))
    return F.transform(F.filter(places, lambda p: p["unlike"]),
                       lambda p: F.struct(p["section"], p["paragraph"]))


# ---- marks and likeness ---------------------------------------------------------------------

def with_marks(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add ``name``, the marks of a text column.

    Sorted hashes come in runs; where a run has several, its members are numbered. The steps
    are columns of their own, as a step used inside a lambda must not be computed for each item.
    """
    pieces = F.regexp_extract_all(text, F.lit(PIECES), F.lit(0))
    hashes, starts, distinct = f"_{name}_hashes", f"_{name}_starts", f"_{name}_distinct"
    df = df.withColumn(hashes, F.sort_array(F.transform(pieces, lambda p: F.xxhash64(F.trim(p)))))
    df = df.withColumn(distinct, F.array_distinct(hashes))
    repeated = F.size(distinct) < F.size(hashes)
    at = F.sequence(F.lit(0), F.size(hashes) - 1)
    df = df.withColumn(starts, F.when(repeated, F.filter(
        at, lambda i: (i == 0) | (F.col(hashes)[i] != F.col(hashes)[i - 1]))))
    ends = F.concat(F.slice(starts, 2, F.size(hashes) + 1), F.array(F.size(hashes)))
    lengths = F.zip_with(starts, ends, lambda a, b: b - a)
    numbers = F.flatten(F.zip_with(distinct, lengths, lambda x, n: F.transform(
        F.sequence(F.lit(1), n), lambda k: F.when(k == 1, x).otherwise(F.xxhash64(x, k)))))
    return df.withColumn(name, F.when(repeated, numbers).otherwise(F.col(hashes))).drop(
        hashes, starts, distinct)


def likeness(root_a: Column, marks_a: Column, root_b: Column, marks_b: Column) -> Column:
    total = F.size(marks_a) + F.size(marks_b)
    share = 2 * F.size(F.array_intersect(marks_a, marks_b)) / F.greatest(total, F.lit(1))
    return F.when(root_a == root_b, 1.0).otherwise(
        F.least(share, 1 - 1 / (total + F.lit(1))))


# ---- fingerprints of edited texts -----------------------------------------------------------

def _neighbours(docs: DataFrame) -> DataFrame:
    """(next_id, before_id, wanted): which document each one follows, and how many of its first
    characters the edited text of that one takes. Ids and sizes only."""
    ids = docs.groupBy("doc_id").agg(F.max("half").alias("half"))
    places = materialise(numbered(ids, "doc_id"), "places")
    last = places.agg(F.count("*")).scalar()
    after = places.select(F.col("doc_id").alias("next_id"), F.col("position").alias("_at"))
    before = places.select(
        F.col("doc_id").alias("before_id"), F.col("half").alias("wanted"),
        (F.col("position") % last + 1).alias("_at"))
    return materialise(after.join(before, "_at").drop("_at"), "neighbours")


def fingerprints_of_edits(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next:
    each document against its edited text, whose last floor(n_chars / 2) characters are the first
    as many of the next document, and against that next document; and where the trees of text and
    edited text differ: in how many branches (paragraphs), and in which first.

    Whole texts are shuffled by id once, for both roles of a document: as the next one of
    another, of which only the part that the edit takes goes on, with its root and marks, and as
    the one that is edited. Sizes are derived after that shuffle, so that both roles read the
    same columns and Spark uses it twice.
    """
    texts = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("text"))
    known = texts.filter(F.col("doc_id").isNotNull())
    placed = known.join(_neighbours(_sized(known)), F.col("doc_id") == F.col("next_id"))
    smallest = Window.partitionBy("doc_id").orderBy("text")
    lent = placed.withColumn("_row", F.row_number().over(smallest)).filter("_row = 1")
    lent = with_marks(lent, "text", "next_marks").select(
        "before_id", F.substring("text", F.lit(1), F.col("wanted")).alias("lent"),
        root(F.col("text")).alias("next_root"), "next_marks")
    followed = known.join(lent, F.col("doc_id") == F.col("before_id"), "left").drop("before_id")
    alone = texts.filter(F.col("doc_id").isNull()).select(
        "*", F.lit("").alias("lent"), root(F.lit("")).alias("next_root"),
        F.array().cast("array<bigint>").alias("next_marks"))
    return _compared(_sized(followed.unionByName(alone)))


def _sized(df: DataFrame) -> DataFrame:
    return df.withColumn("n_chars", F.length("text").cast("long")).withColumn(
        "half", F.floor(F.col("n_chars") / 2).cast("int"))


def _compared(df: DataFrame) -> DataFrame:
    head = F.substring("text", F.lit(1), (F.col("n_chars") - F.col("half")).cast("int"))
    df = df.withColumn("edited", F.concat(
        head, F.substring("lent", F.lit(1), F.col("half"))))
    df = with_marks(with_marks(df, "text", "marks"), "edited", "edited_marks")
    df = df.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        tree(F.col("text")).alias("tree"), tree(F.col("edited")).alias("edited_tree"),
        "marks", "edited_marks", "next_root", "next_marks")
    df = df.select(
        "*", root_of(F.col("tree")).alias("fingerprint"),
        root_of(F.col("edited_tree")).alias("edited_fingerprint"))
    # Only trees whose roots differ are gone down.
    df = df.withColumn("branches", F.when(
        F.col("fingerprint") != F.col("edited_fingerprint"),
        differing(F.col("tree"), F.col("edited_tree"))))
    first = F.get("branches", F.lit(0))
    return df.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        F.coalesce(F.size("branches"), F.lit(0)).alias("edited_branches"),
        first["section"].alias("first_section"), first["paragraph"].alias("first_paragraph"),
        likeness(F.col("fingerprint"), F.col("marks"), F.col("edited_fingerprint"),
                 F.col("edited_marks")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("marks"), F.col("next_root"),
                 F.col("next_marks")).alias("near_next"))
