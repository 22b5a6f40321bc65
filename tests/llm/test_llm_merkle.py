import hashlib
import random

import pytest

from tessera.llm import merkle
from tessera.llm.queries import op4_merkle

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, fingerprint string, n_chars string"


def brute(rows):
    """Rows in order -> what the query returns."""
    out = []
    for i, (d, t) in enumerate(rows):
        t, nxt = t or "", rows[(i + 1) % len(rows)][1] or ""
        k = len(t) // 2
        e = t[: len(t) - k] + nxt[:k]
        f, g, h = (merkle.fingerprint(x) for x in (t, e, nxt))
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), f, g, merkle.likeness(merkle.read(f), merkle.read(g)), merkle.likeness(merkle.read(f), merkle.read(h))))
    return out


def test_query_equals_brute_force(spark):
    got = sorted(tuple(r) for r in op4_merkle(spark, SF).collect())
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    want = brute(rows)
    assert got == want
    assert sum(r[5] > r[6] for r in want) > 0.95 * len(want)  # the edited text is nearer than the next


def test_odd_rows(spark):
    rows = [(1, "Über alles. Ünd.\n\nTwo."), (2, None), (3, ""), (4, "x" * 100_000), (5, "a"), (6, "Über alles. Ünd.\n\nTwo.")]
    got = sorted(tuple(r) for r in merkle.compare_neighbours(spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA)).drop("edited_text").collect())
    assert got == [(r[0], r[1], *r[3:]) for r in brute(rows)]
    assert got[0][2] == got[5][2]
    one = merkle.compare_neighbours(spark.createDataFrame([(9, "only one here", "", "")], SCHEMA)).first()
    assert one.edited_text == "only one" [:7] + "only o" and one.near_next == 1.0
    assert merkle.compare_neighbours(spark.createDataFrame([], SCHEMA)).count() == 0


def test_null_and_repeated_ids(spark):
    rows = [(None, f"null {i}", "", "") for i in range(9)] + [(2, "two", "", ""), (2, "two", "", ""), (2, "zwei", "", ""), (1, "one", "", "")]
    got = merkle.compare_neighbours(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or -1, r.n_chars) for r in got) == sorted((d or -1, len(t)) for d, t, *_ in rows)
    by = {(r.doc_id, r.fingerprint): r.edited_text for r in got if r.doc_id}
    assert by[1, merkle.fingerprint("one")] in ("on" + "t", "on" + "z")
    assert {r.edited_text[-1] for r in got if r.n_chars == 6 and r.doc_id is None} <= {"l", "e", "n", "o"} | set("0123456789u")


def test_pieces_join_to_the_text_and_trees_read_back():
    r = random.Random(8)
    for _ in range(200):
        text = "".join(r.choice(["a", "word ", "é", ". ", "!", "?\n", "\n", "\n\n", "x" * 90, "...", "\r\n"]) for _ in range(r.randrange(40)))
        t = merkle.tree(text)
        spans = [(b, e) for s in t.sections for p in s.paragraphs for b, e in zip([p.begin, *p.ends], p.ends, strict=False)]
        assert "".join(text[b:e] for b, e in spans) == text
        back = merkle.read(merkle.write(t))
        assert merkle.write(back) == merkle.write(t)
        assert [p.leaves for s in back.sections for p in s.paragraphs] == [p.leaves for s in t.sections for p in s.paragraphs]


def test_an_unchanged_half_of_a_short_text_is_seen(spark):
    r = random.Random(3)
    words = ["".join(r.choices("abcdefghij", k=r.randrange(2, 9))) for _ in range(3000)]
    texts = [" ".join(r.choices(words, k=k)) + r.choice(["", ".", ". Ja!"]) for k in (*range(4, 60), 150, 400, 900)] + ["x" * 40, "ein wort", "été " * 30]
    for t, other in zip(texts, texts[1:], strict=False):
        own, changed, nxt = (merkle.tree(x) for x in (t, merkle.edited(t, other), other))
        assert merkle.likeness(own, changed) > 0, t
        assert merkle.likeness(own, changed) == merkle.likeness(changed, own) == merkle.likeness(merkle.read(merkle.write(own)), merkle.read(merkle.write(changed)))
        assert len(t) < 100 or len(other) < 100 or merkle.likeness(own, nxt) < 0.1
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    none = docs.join(merkle.compare_neighbours(docs).where("near_edited = 0").select("doc_id"), "doc_id").collect()
    # nothing is in common only where the kept half holds no whole word
    assert all(len(d.text[: len(d.text) - len(d.text) // 2].split()) <= 1 for d in none)


def test_units_join_to_nothing_lost_and_short_texts_meet_long_ones():
    short = "One two three four. Five six."
    long = short + " " + "Seven eight nine ten. " * 100
    a, b = merkle.tree(short), merkle.tree(long)
    assert all(len(p.units) == len(p.leaves) for s in a.sections for p in s.paragraphs) and not b.sections[0].paragraphs[0].units
    assert 0 < merkle.likeness(a, b) == merkle.likeness(b, a) < 0.2  # by pieces, which both have
    assert merkle.likeness(a, a) == 1.0 and merkle.likeness(merkle.tree(""), a) == 0.0


def test_roots_tell_equality_and_branches_locate_edits():
    text = "".join(f"Paragraph {i} says this. And that, too.\n" + ("\n" if i % 4 == 3 else "") for i in range(40))
    at = text.index("Paragraph 22")
    new = text[:at] + "Changed 22" + text[at + 12 :]
    assert merkle.fingerprint(text) != merkle.fingerprint(new)
    ((b, e),) = merkle.edits(text, new)
    assert b <= at and new[b:e].startswith("Changed 22 says") and e - b < 60
    assert merkle.edits(text, text) == []
    a, c = merkle.tree(text), merkle.tree(new)
    assert merkle.likeness(a, c) == pytest.approx(79 / 80)
    assert merkle.likeness(a, merkle.tree("")) == 0 and merkle.likeness(merkle.tree(""), merkle.tree("")) == 1
    assert 0 < merkle.likeness(a, merkle.tree(text[: len(text) // 2])) < 1
