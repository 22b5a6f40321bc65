"""Document fingerprints: a Merkle tree over sections and paragraphs.

A text is cut into sections, sections into paragraphs, paragraphs into pieces,
so that joining the pieces gives the text again, to the last character:

* a paragraph ends after its line breaks;
* a section ends after a blank line, and after a paragraph whose hash is a
  multiple of ``SECTION_EVERY`` (so texts without blank lines have sections
  too, and an edit moves no other boundary);
* a piece is a sentence with the marks and space that end it, at most
  ``PIECE_CHARS`` long;
* texts of up to ``FINE_CHARS`` code points have one more level, as half of
  them may hold no whole piece: units of one to four words, which end after
  the first word of a piece and after words whose hash says so.

Leaves are hashes of pieces, the node of a paragraph hashes its leaves, that
of a section its paragraphs, the root its sections. Equal roots mean equal
texts; where roots differ, only branches whose nodes differ are opened, which
locates the edit.

The fingerprint is the tree written out: the root, then the sections between
``/``, each with its node and, after ``:``, its paragraphs between ``,``, each
a node of 12 hex digits followed by its leaves of 8; in short texts then ``=``
and the units of each leaf, of 6 hex digits, between ``.``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import buckets_by

PIECE_CHARS = 160
SECTION_EVERY = 8
FINE_CHARS = 1000
UNIT_WORDS = 4
ROOT, NODE, LEAF, UNIT = 32, 12, 8, 6
_PARAGRAPH = regex.compile(r"[^\n]*\n+|[^\n]+")
_PIECE = regex.compile(r"[^.!?]{1,%d}(?:[.!?]+\s*)?|[.!?]+\s*" % PIECE_CHARS)
_WORD = regex.compile(r"\S{1,16}\s{0,16}|\s{1,16}")


class Paragraph(NamedTuple):
    node: str
    leaves: list[str]
    begin: int
    ends: list[int]
    units: list[list[str]]  # of each leaf; empty in texts that are not short


class Section(NamedTuple):
    node: str
    paragraphs: list[Paragraph]


class Tree(NamedTuple):
    root: str
    sections: list[Section]


def _hash(parts: list[str]) -> str:
    return xxhash.xxh3_128_hexdigest("".join(parts).encode("ascii"))


def _units(piece: str) -> list[str]:
    """Hashes of the units of a piece."""
    out, unit, n = [], b"", UNIT_WORDS - 1
    for w in _WORD.findall(piece):
        word = w.encode("utf-8", "surrogatepass")
        unit, n = unit + word, n + 1
        if n == UNIT_WORDS or crc32(word) % 3 == 0:
            out.append(xxhash.xxh3_64_hexdigest(unit)[:UNIT])
            unit, n = b"", 0
    if unit:
        out.append(xxhash.xxh3_64_hexdigest(unit)[:UNIT])
    return out


def tree(text: str) -> Tree:
    """The tree of a whole text, with the spans of its pieces."""
    fine = len(text) <= FINE_CHARS
    digest, sections, own, at = xxhash.xxh3_128_hexdigest, [], [], 0
    full_nodes: list[str] = []
    section_nodes: list[str] = []

    def close() -> None:
        node = _hash(full_nodes)
        sections.append(Section(node[:NODE], list(own)))
        section_nodes.append(node)
        own.clear()
        full_nodes.clear()

    for p in _PARAGRAPH.findall(text):
        pieces = _PIECE.findall(p)
        full = [digest(x.encode("utf-8", "surrogatepass")) for x in pieces]
        node = _hash(full)
        ends, end = [], at
        for x in pieces:
            end += len(x)
            ends.append(end)
        own.append(Paragraph(node[:NODE], [x[:LEAF] for x in full], at, ends, [_units(x) for x in pieces] if fine else []))
        full_nodes.append(node)
        at = end
        if p.endswith("\n\n") or int(node[-8:], 16) % SECTION_EVERY == 0:
            close()
    if own:
        close()
    return Tree(_hash(section_nodes), sections)


def write(t: Tree) -> str:
    """The fingerprint: the tree as text."""
    return "/".join([t.root, *[f"{s.node}:" + ",".join([_written(p) for p in s.paragraphs]) for s in t.sections]])


def _written(p: Paragraph) -> str:
    return p.node + "".join(p.leaves) + ("=" + ".".join(["".join(u) for u in p.units]) if p.units else "")


def fingerprint(text: str | None) -> str:
    """The fingerprint of a whole text; NULL counts as the empty text."""
    return write(tree(text or ""))


def read(fp: str) -> Tree:
    """The tree of a fingerprint, without spans."""
    root, *sections = fp.split("/")
    made = []
    for s in sections:
        node, _, rest = s.partition(":")
        made.append(Section(node, [_read(p) for p in rest.split(",")]))
    return Tree(root, made)


def _read(p: str) -> Paragraph:
    upper, _, units = p.partition("=")
    leaves = [upper[i : i + LEAF] for i in range(NODE, len(upper), LEAF)]
    return Paragraph(upper[:NODE], leaves, 0, [], [[u[i : i + UNIT] for i in range(0, len(u), UNIT)] for u in units.split(".")] if units else [])


def likeness(a: Tree, b: Tree) -> float:
    """1 for equal roots; else twice the leaves in common over all leaves, or
    the units instead if both texts have them. Branches with equal nodes are
    not opened."""
    if a.root == b.root:
        return 1.0
    pa_, pb = ([p for s in t.sections for p in s.paragraphs] for t in (a, b))
    if not pa_ or not pb:
        return 0.0
    fine = bool(pa_[0].units and pb[0].units)
    total = _size(pa_, fine) + _size(pb, fine)
    common = _size(pa_, fine)  # less what is in no equal branch
    same = Counter(s.node for s in a.sections) & Counter(s.node for s in b.sections)
    pa_, pb = ([p for s in _unmatched(t.sections, same) for p in s.paragraphs] for t in (a, b))
    same = Counter(p.node for p in pa_) & Counter(p.node for p in pb)
    pa_, pb = _unmatched(pa_, same), _unmatched(pb, same)
    common -= _size(pa_, fine)
    same = Counter(x for p in pa_ for x in p.leaves) & Counter(x for p in pb for x in p.leaves)
    if not fine:
        return 2 * (common + same.total()) / total
    ua, ub = (_unmatched([Leaf(x, u) for p in ps for x, u in zip(p.leaves, p.units, strict=True)], same) for ps in (pa_, pb))
    common += _size(pa_, fine) - sum(len(x.units) for x in ua)
    common += (Counter(u for x in ua for u in x.units) & Counter(u for x in ub for u in x.units)).total()
    return 2 * common / total


class Leaf(NamedTuple):
    node: str
    units: list[str]


def _size(paragraphs: list[Paragraph], fine: bool) -> int:
    """Leaves of the paragraphs, or their units."""
    return sum(sum(map(len, p.units)) if fine else len(p.leaves) for p in paragraphs)


def _unmatched(nodes: list, same: Counter) -> list:
    left = Counter(same)
    out = []
    for x in nodes:
        if left[x.node] > 0:
            left[x.node] -= 1
        else:
            out.append(x)
    return out


def edits(old: str, new: str) -> list[tuple[int, int]]:
    """Spans ``(begin, end)`` of ``new`` whose pieces the tree of ``old`` does
    not hold, found by opening differing branches only; neighbours joined."""
    a, b = tree(old), tree(new)
    if a.root == b.root:
        return []
    known_s = {s.node for s in a.sections}
    known_p = {p.node for s in a.sections for p in s.paragraphs}
    known_l = {x for s in a.sections for p in s.paragraphs for x in p.leaves}
    out: list[tuple[int, int]] = []
    for s in b.sections:
        if s.node in known_s:
            continue
        for p in s.paragraphs:
            if p.node in known_p:
                continue
            for begin, end, leaf in zip([p.begin, *p.ends], p.ends, p.leaves, strict=False):
                if leaf in known_l:
                    continue
                if out and out[-1][1] == begin:
                    out[-1] = (out[-1][0], end)
                else:
                    out.append((begin, end))
    return out


def fingerprint_table(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` and the ``fingerprint`` of every row, from its whole text. NULL
    and empty texts have that of the empty text; repeated rows stay, each with
    the same one; an empty table gives an empty result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = pa.array([fingerprint(t) for t in b.column(len(keep)).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], fps], [*keep, "fingerprint"])

    kinds = dict(docs.dtypes)
    ddl = "".join(f"`{c}` {kinds[c]}, " for c in keep) + "fingerprint string"
    return docs.select(*keep, F.col(text_col).alias("__in")).mapInArrow(run, ddl)


def edited(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by the first as
    many code points of ``following`` (or all, if it has fewer)."""
    k = len(text) // 2
    return text[: len(text) - k] + following[:k]


_OUT = "doc_id long, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def compare_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of every text, of its edited text, and how near they and
    the next document's are: ``doc_id, n_chars, edited_text, fingerprint,
    edited_fingerprint, near_edited, near_next``.

    The next document is the one that follows in ascending order of id (NULL
    ids last, ties by a hash of the text), after the last the first; a single
    document follows itself. NULL texts count as empty; repeated rows follow
    one another; an empty table gives an empty result.

    Ids are cut into consecutive buckets; each bucket is read in order, one
    document at a time. The first document of a bucket is also sent to the
    bucket before it, as the follower of that one's last."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("hash"), F.col(text_col).alias("text")
    )
    buckets = buckets_by(docs, id_col)
    # one id (or, of NULL ids, one hash) for each bucket: thousands, whatever the table
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id")).where("doc_id is not null").select("doc_id", F.lit(0).cast("long").alias("hash"))
    first = slim.groupBy(buckets.column("doc_id", "hash").alias("b")).agg(F.min("doc_id").alias("k")).collect()
    nulls = rows.where("doc_id is null")
    first += nulls.groupBy(buckets.column("doc_id", "hash").alias("b")).agg(F.min("hash").alias("k")).collect()
    first.sort(key=lambda r: r.b)
    edge = len(buckets.bounds)
    heads: dict[tuple[bool, int], int] = {(r.b > edge, r.k): first[i - 1].b for i, r in enumerate(first)}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bucket = buckets.of(b.column(0), b.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(bucket), pa.array([0] * len(bucket), pa.int32()), *b.columns], _DEALT.names)
            keys = zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
            at = [(i, heads[k]) for i, (d, h) in enumerate(keys) if (k := (d is None, h if d is None else d)) in heads]
            if at:
                own = b.take(pa.array([i for i, _ in at]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([to for _, to in at], pa.int32()), pa.array([1] * len(at), pa.int32()), *own.columns], _DEALT.names
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the document whose follower has not come yet: bucket, id, text, tree
        for whole in batches:
            for s in range(0, whole.num_rows, 256):
                out = []
                b = whole.slice(s, 256)
                for bucket, copy, d, _, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    t = t or ""
                    if held is not None and held[0] != bucket:
                        held = None  # its follower has come already
                    if held is None and copy:
                        continue
                    own = tree(t)
                    if held is not None:
                        out.append(_pair(*held[1:], t, own))
                    held = None if copy else (bucket, d, t, own)
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(_KINDS)], _NAMES)

    dealt = rows.mapInArrow(deal, "bucket int, copy int, doc_id long, hash long, text string")
    # as many tasks as buckets: a task holds about one, whatever the table
    dealt = dealt.repartition(len(buckets), "bucket").sortWithinPartitions("bucket", "copy", "doc_id", "hash")
    return dealt.mapInArrow(run, _OUT)


_DEALT = pa.schema([("bucket", pa.int32()), ("copy", pa.int32()), ("doc_id", pa.int64()), ("hash", pa.int64()), ("text", pa.string())])
_NAMES = [c.split()[0] for c in _OUT.split(", ")]
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _pair(d: int | None, text: str, own: Tree, following: str, after: Tree) -> tuple:
    changed = edited(text, following)
    t = tree(changed)
    return (d, len(text), changed, write(own), write(t), likeness(own, t), likeness(own, after))
