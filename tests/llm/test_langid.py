from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest

from vayumark.llm import langid as op

SYLLABLES = {"aa": "ka to mi ne ru sa", "bb": "sch ung eit pf ber tz", "cc": "ción ando eza ñor que lla"}
ROWS = "doc_id long, text string, lang string, score string, langs string"


def text(lang, seed, n=60):
    pick, parts = random.Random(seed), SYLLABLES[lang].split()
    return " ".join("".join(pick.choice(parts) for _ in range(pick.randint(1, 3))) for _ in range(n))


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", "l") for r in rows], ROWS)


def test_held_out_accuracy_and_fold(spark):
    rows = [(n, text(lang, n), lang) for n, lang in ((n, list(SYLLABLES)[n % 3]) for n in range(300))]
    docs = frame(spark, rows)
    marked = docs.withColumn("held_out", op.fold(docs) == 1)
    assert {r.doc_id for r in marked.filter("held_out").collect()} == {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    model = op.train(marked.filter("not held_out"))
    got = op.identify(marked.filter("held_out"), model, "doc_id").collect()
    assert all(r.lang_pred == rows[r.doc_id][2] and 0.9 < r.score <= 1 for r in got)


def test_mixtures_and_odd_rows(spark):
    rows = [(n, text(lang, n), lang) for n, lang in ((n, list(SYLLABLES)[n % 3]) for n in range(90))]
    rows += [(200, None, "aa"), (201, text("aa", 1), None), (202, "123 !?", "bb"), (1, text("bb", 7), "bb")]
    model = op.train(frame(spark, rows), most=20)
    assert list(model) == ["aa", "bb", "cc"] and all(abs(p.sum() - 1) < 1e-9 for p in model.values())
    asked = [(1, f"{text('aa', 5, 70)} {text('bb', 6, 30)}", None), (2, None, "aa"), (3, "", "aa"), (4, "12 😀 -", "aa"), (None, text("cc", 9, 30_000), "x"), (1, "É", "x")]
    got = op.identify(frame(spark, asked), model, "doc_id").collect()
    assert got[0].lang_pred == "aa" and set(got[0].langs) == {"aa", "bb"} and abs(got[0].langs["aa"] - 0.6) < 0.2
    assert [(r.lang_pred, r.score) for r in got[1:4]] == [("und", 0.0)] * 3
    assert got[4].lang_pred == "cc" and got[5].lang_pred in model and 0 <= got[5].score <= 1


def test_no_language_is_lost_to_an_id_that_repeats(spark):
    """All rows of one language have one id, some are equal; the other language is small."""
    rows = [(7, text("aa", n % 400), "aa") for n in range(500)] + [(1000 + n, text("bb", n), "bb") for n in range(50)]
    rows += [(7, text("cc", n), "cc") for n in range(30)] + [(None, text("cc", 3), "dd")]
    for most in (20, 1000):
        model = op.train(frame(spark, rows), most=most)
        assert list(model) == ["aa", "bb", "cc"]
        got = op.identify(frame(spark, [(1, text(lang, 9999), lang) for lang in model]), model, "doc_id").collect()
        assert [r.lang_pred for r in got] == ["aa", "bb", "cc"]


def test_equal_rows_teach_once(spark):
    rows = [(n, text("aa", n), "aa") for n in range(10)]
    once, often = (op.train(frame(spark, r)) for r in (rows, rows + [rows[0]] * 200))
    assert np.allclose(once["aa"], often["aa"])


def test_many_languages_and_a_model_that_is_too_large(spark, monkeypatch):
    names = [f"l{n:03}" for n in range(300)]
    rows = [(n, " ".join(f"{chr(0x4E00 + 40 * n + k)}{chr(0x4E00 + 40 * n + k + 1)}" for k in range(30)), name) for n, name in enumerate(names)]
    model = op.train(frame(spark, rows))
    assert list(model) == names
    got = op.identify(frame(spark, rows[::50]), model, "doc_id").collect()
    assert [r.lang_pred for r in got] == names[::50]
    monkeypatch.setattr(op, "MOST_BYTES", 100 * op.BUCKETS * 8)
    with pytest.raises(ValueError, match="100 languages"):
        op.train(frame(spark, rows))
    with pytest.raises(ValueError, match="over"):
        op.identify(frame(spark, rows), model, "doc_id")


def slow_grams(value):
    """N-grams one by one in whole numbers."""
    kept = " ".join("".join(c if c.isalpha() else " " for c in value.lower()).split())
    if not kept:
        return {}
    padded, mask, counts = f" {kept} ", (1 << 64) - 1, {}
    for size in (1, 2, 3):
        for at in range(len(padded) - size + 1):
            part = padded[at : at + size]
            if part == " ":
                continue
            h = ord(part[0]) * 0x9E3779B97F4A7C15 & mask
            for k, factor in zip(range(1, size), (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9), strict=False):
                h = ((h ^ h >> 31) * factor + ord(part[k]) * 0x9E3779B97F4A7C15) & mask
            h = (h ^ h >> 29) * 0xBF58476D1CE4E5B9 & mask
            counts[h >> 49] = counts.get(h >> 49, 0) + 1
    return counts


def slow_shares(table, counts):
    """Expectation-maximisation with dictionaries."""
    share = {lang: 1 / len(table) for lang in table}
    total = sum(counts.values())
    for _ in range(op.ROUNDS if len(table) > 1 else 0):
        gained = dict.fromkeys(table, 0.0)
        for gram, n in counts.items():
            whole = sum(share[lang] * table[lang][gram] for lang in table)
            for lang in table:
                gained[lang] += n * share[lang] * table[lang][gram] / whole
        share = {lang: g / total for lang, g in gained.items()}
    value = sum(n * math.log(sum(share[lang] * table[lang][gram] for lang in table)) for gram, n in counts.items())
    return share, value


def slow_identify(model, value):
    counts = slow_grams(value)
    if not counts:
        return "und", 0.0
    share, _ = slow_shares(model, counts)
    order = sorted(model, key=lambda lang: -share[lang])
    best = None
    for size in range(1, len(order) + 1):
        some, got = slow_shares({lang: model[lang] for lang in order[:size]}, counts)
        got = got * op.INDEPENDENT - 0.5 * math.log(max(2.0, sum(counts.values()) * op.INDEPENDENT)) * (size - 1)
        if best and got <= best[0]:
            break
        best = (got, some)
    top = max(best[1], key=best[1].get)
    return top, best[1][top]


def test_every_row_as_by_the_slow_way(spark):
    rows = [(n, text(lang, n), lang) for n, lang in ((n, list(SYLLABLES)[n % 3]) for n in range(60))]
    model = op.train(frame(spark, rows))
    asked = [(n, f"{text('aa', n, 3 * n)} {text('bb', n, 40 - n)} {text('cc', n, 2 + n % 5)}", None) for n in range(1, 40, 4)]
    asked += [(100, "Ünï-cödé Wörter 123 abc", None), (101, "x", None), (102, "?? 1", None), (103, "中文 字 und", None), (104, "a\u0301b\u200dc", None)]
    blank = op.letters_table()
    for _, value, _ in asked:
        found = op.grams(value, blank)
        assert (dict(zip(*map(list, found), strict=True)) if found else {}) == slow_grams(value)
    for r, (_, value, _) in zip(op.identify(frame(spark, asked), model, "doc_id").collect(), asked, strict=True):
        name, score = slow_identify(model, value)
        assert r.lang_pred == name and abs(r.score - score) < 1e-9


def test_nothing_learned(spark):
    rows = [(1, "some text", None), (2, None, "aa")]
    model = op.train(frame(spark, rows))
    assert model == {}
    assert [r.lang_pred for r in op.identify(frame(spark, rows), model, "doc_id").collect()] == ["und", "und"]
    assert op.identify(frame(spark, []), model, "doc_id").count() == 0


def test_expectation_maximisation_finds_the_shares():
    likelihood = np.array([[0.6, 0.3, 0.1], [0.1, 0.3, 0.6]])
    share, _ = op.proportions(likelihood, np.array([0.75, 0.25]) @ likelihood * 1000)
    assert abs(share[0] - 0.75) < 0.03
