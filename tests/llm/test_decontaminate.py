from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from podium.llm import decontaminate as d

from .helpers import CLASHES, awkward, frame, prose

ITEMS = "item_id bigint, text string"


def tokens(text):
    lowered = "".join(c.lower() if c < "\x80" else c for c in text or "")
    return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lowered)


def distance(item, text):
    """Least edits between the item and any run of the text's words."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item):
        new = [i + 1]
        for j, y in enumerate(text):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def brute(rows, items):
    out = {}
    for k, (i, t) in enumerate(rows):
        text = tokens(t)
        for item_id, item in items:
            own = tokens(item)
            if own and item_id is not None:
                n = distance(own, text)
                if n <= int(d.EDITS * len(own)):
                    out[(i, item_id)] = n
    return out


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at, kind = rng.randrange(len(words)), rng.randrange(3)
        if kind == 0:
            words[at] = f"edit{rng.randrange(1000)}"
        elif kind == 1:
            words.insert(at, f"edit{rng.randrange(1000)}")
        elif len(words) > 1:
            del words[at]
    return words


def planted(seed, share, n=150):
    rng = random.Random(seed)
    items = [(i, prose(rng, rng.randint(10, 60), 2000)) for i in range(30)]
    rows = []
    for i in range(n):
        words = prose(rng, rng.randint(20, 300), 2000).split()
        if i % 2:
            own = tokens(rng.choice(items)[1])
            at = rng.randrange(len(words))
            words[at:at] = edited(rng, own, int(share * len(own)))
        rows.append((i, " ".join(words)))
    return rows, items


@pytest.mark.parametrize("share, least", [(0.0, 1.0), (0.1, 0.97), (0.2, 0.9)])
def test_recall_reaches_its_target_and_every_hit_is_exact(spark, share, least):
    rows, items = planted(1, share)
    want = brute(rows, items)
    found = d.contaminated(frame(spark, rows, clashes=True), spark.createDataFrame(items, ITEMS))
    got = {(r.doc_id, r.item_id): r.distance for r in found.collect()}
    assert len(want) >= 60 and len(got) >= least * len(want)
    assert all(want[k] == n for k, n in got.items())


def test_case_marks_spaces_and_short_items(spark):
    items = [(1, "Where is the, nearest STATION?"), (2, "yes"), (3, "..."), (4, None), (None, "yes"), (5, "a b c d e f g")]
    rows = [(1, "well where\nis THE nearest -- station then"), (2, "Yes!"), (3, "where was the nearest station"),
            (4, "x a b c q e f g y"), (5, "a b c"), (6, None), (7, "")]
    found = d.contaminated(frame(spark, rows), spark.createDataFrame(items, ITEMS)).collect()
    assert {(r.doc_id, r.item_id): r.distance for r in found} == {(1, 1): 0, (2, 2): 0, (3, 1): 1, (4, 5): 1}
    place = next(r for r in found if r.doc_id == 1)
    assert (place.first_word, place.last_word) == (1, 5)


def test_blocks_of_items_find_the_same(spark, monkeypatch):
    rows, items = planted(2, 0.1, 60)
    both = frame(spark, rows), spark.createDataFrame(items, ITEMS)
    whole = sorted(d.contaminated(*both).collect())
    monkeypatch.setattr(d, "BLOCK_CHARS", 2000)
    assert sorted(d.contaminated(*both).collect()) == whole
    left = {r.doc_id for r in d.drop_contaminated(*both).collect()}
    assert left == {i for i, _ in rows} - {r.doc_id for r in whole}


def test_awkward_documents(spark):
    rows = awkward()
    items = [(1, next(t for i, t in rows if i == 5)), (1, "no id at all"), (2, "")]
    df, items_df = frame(spark, rows, clashes=True), spark.createDataFrame(items, ITEMS)
    want = brute(rows, items)
    got = d.contaminated(df, items_df).collect()
    assert {(r.doc_id, r.item_id) for r in got} == set(want)
    clean = d.drop_contaminated(df, items_df)
    assert clean.columns == df.columns
    out = clean.collect()
    assert all(r[c] == f"own {c}" for r in out for c in CLASHES)
    texts = [(i, t) for i, t in rows if not any(distance(tokens(x), tokens(t)) <= int(0.2 * len(tokens(x))) for _, x in items if x)]
    assert sorted(((r.doc_id, r.text) for r in out), key=str) == sorted(texts, key=str)


def test_empty_tables(spark):
    none, item = spark.createDataFrame([], ITEMS), spark.createDataFrame([(1, "a b")], ITEMS)
    for docs, items in ((frame(spark, []), item), (frame(spark, awkward()), none)):
        assert d.contaminated(docs, items).count() == 0
        assert d.drop_contaminated(docs, items).count() == docs.count()


def test_matcher_equals_dynamic_programming():
    rng = random.Random(0)
    for _ in range(400):
        item = [rng.randrange(5) for _ in range(rng.randint(1, 12))]
        text = [rng.randrange(5) for _ in range(rng.randint(0, 20))]
        best = distance(item, text)
        got = d.best_match(np.array(item), np.array(text), len(item))
        if text:
            assert got[0] == best
            assert distance(item, text[got[1] : got[2]]) == best or got[1] >= got[2]
        else:
            assert got is None


def test_near_windows_share_sketches_more_often_than_far_ones():
    rng = random.Random(3)

    def shared(a, b):
        both = [d.words_in(pa.array([" ".join(x)]))[0] for x in (a, b)]
        x, y = (d.sketches(w, np.array([0]), np.array([len(w)])) for w in both)
        return (x == y).any()

    base = [prose(rng, 30, 3000).split() for _ in range(200)]
    near = np.mean([shared(b, edited(rng, b, 2)) for b in base])
    far = np.mean([shared(b, prose(rng, 30, 3000).split()) for b in base])
    assert near > 0.75 and far < 0.02
