"""Small tables with everything that real ones hold: nulls, copies, clashes, long texts."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, size string, row string, fp string, core string"


def words(seed: int, n: int) -> str:
    pick = random.Random(seed)
    return " ".join("".join(pick.choice("abcdefghij") for _ in range(pick.randint(2, 7))) for _ in range(n))


def documents(spark, texts: list[tuple[int | None, str | None]]):
    """A documents table with further columns whose names the operators use inside."""
    rows = [(i, t, "en", f"src{n % 3}" if n % 5 else None, len(t or ""), "k", "s", "r", "f", "c") for n, (i, t) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def corpus() -> list[tuple[int | None, str | None]]:
    base = [words(n, 120) for n in range(12)]
    passage = words(99, 60)
    texts: list[tuple[int | None, str | None]] = [(n, t) for n, t in enumerate(base)]
    texts += [(20 + n, f"{t[: 150 + 40 * n]} {passage} {t[200:]}") for n, t in enumerate(base[:4])]
    texts += [(30, base[5]), (31, base[5]), (31, base[5])]  # copies and a repeated row
    texts += [(32, base[6][:-9] + "zz"), (33, base[7] + "!"), (34, base[7].upper())]
    texts += [(40, None), (41, ""), (42, " \n\t "), (43, "short"), (44, "a" * 700), (45, "ab" * 400), (46, "é€😀" * 120)]
    texts += [(50, words(51, 30_000)), (None, base[8]), (None, words(52, 80)), (20, words(53, 90))]
    texts += [(60, "one line\none line\n\n\none line\nother\n" * 3), (61, "x y " * 100), (62, "#a $b %c |d <e> &f *g")]
    return texts
