import random
import re
import zlib
from collections import Counter

import pytest

from tessera.llm import variants


def plain_words(rows, min_length, min_count, every):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-z\xc0-\xff]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= min_length:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= min_count}


def one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(n, ratio=5):
    near = {w: [v for v in n if one_apart(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return out


def vocabulary(seed, letters="ab\xe9", longest=6, size=150):
    draw = random.Random(seed)
    words = {"".join(draw.choice(letters) for _ in range(draw.randint(1, longest))) for _ in range(size)}
    return {w: draw.choice([1, 5, 5, 25, 30, 200, 4000]) for w in words}


def frame(spark, n):
    return spark.createDataFrame(list(n.items()), "word string, n long")


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("stem", ["", "internationalisations", "x" * 70])
def test_equals_comparing_all_words(spark, seed, stem):
    n = vocabulary(seed, size=120)
    n = {stem[:-7] + w + stem[-7:] if stem else w: c for w, c in n.items()}
    got = variants.group_variants(frame(spark, n))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {tuple(r) for r in got.collect()} == plain_variants(n)


def test_equal_neighbouring_letters_count_once(spark):
    n = {"aaa": 1, "aaaa": 9, "aaaaa": 100, "aaba": 7, "aabaa": 2}
    assert {tuple(r) for r in variants.group_variants(frame(spark, n), 2).collect()} == plain_variants(n, 2)


def test_long_chain_of_forms(spark):
    word, n = "abcdefgh", {}
    for k in range(11):
        n[word + "x" * k] = 2**k
    rows = {r.word: r for r in variants.group_variants(frame(spark, n), 2).collect()}
    assert rows[word].root == word + "x" * 10 and rows[word].form == word + "x"
    assert {tuple(r) for r in rows.values()} == plain_variants(n, 2)


def test_nodes_are_numbered_once(spark):
    words = variants.numbered(frame(spark, vocabulary(9, "abc", 14, 200)))
    names = {r.id: r.word for r in words.collect()}
    assert [names[i] for i in sorted(names)] == sorted(names.values())
    prefix, suffix = {}, {}
    for r in variants._filed(words).collect():  # the place of each pair, by the order in which it is filed
        prefix.setdefault(r.id, []).append(r)
    made = {}
    for r in variants.node_pairs(words).collect():
        made.setdefault(r.id, set()).add((r.p, r.s, r.skipped))
    for i, word in names.items():
        assert len(made[i]) == 2 * len(word) + 1
        assert len(prefix[i]) == 2 * len(word) + 1
    for text in ("", "a", "abz\xff", "z" * 9):
        prefix_number = variants._walk(text)[-1][0]
        assert suffix.setdefault(prefix_number, text) == text


def test_very_long_words(spark):
    long = "abcdefghij" * 3000
    n = {long: 50, long[:-1]: 5, long[:9000] + "z" + long[9001:]: 6, long[:5000] + long[5001:]: 7, "abcdef": 3}
    rows = {r.word: r for r in variants.group_variants(frame(spark, n)).collect()}
    assert rows[long].n_near == 3 and rows[long].form is None
    assert all(rows[w].form == long for w in n if w not in (long, "abcdef"))


def test_words_of_texts(spark):
    draw = random.Random(4)
    words = ["Because", "becausE", "THROUGH", "\xc9cole\xe8re", "\xe9cole\xe8re", "na\xefve", "naive", "xĀletters", "cou\xf7ld", "walks2walked"]
    rows = [(draw.choice([i, None, i]), " ".join(draw.choice(words) for _ in range(60))) for i in range(40)]
    rows += [(1, None), (2, ""), (3, "中文 12 short"), *rows[:5]]
    df = spark.createDataFrame([(*r, "a", 1) for r in rows], "doc_id long, text string, run string, n int")
    for every in (None, 3, 199):
        want = plain_words(rows, 6, 5, every)
        assert {r.word: r.n for r in variants.word_counts(df, misspell_every=every).collect()} == want
        assert {tuple(r) for r in variants.spelling_variants(df, misspell_every=every).collect()} == plain_variants(want)
    assert variants.spelling_variants(df.limit(0)).collect() == []
    assert variants.spelling_variants(df.where("doc_id = 2 and text = ''")).collect() == []
