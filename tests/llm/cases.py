"""Documents with everything that may go wrong, and exact brute force to hold operators against."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, first string, v string, score string, block string, lead string, places string, `a b` int"


def prose(rng: random.Random, words: int) -> str:
    syllables = ["ka", "lo", "mi", "ter", "un", "so", "pre", "nd", "el", "qui"]
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(words))


def texts(seed: int = 1) -> list[tuple]:
    """(doc_id, text) with copies, near copies, shared passages, nulls, empty and long texts."""
    rng = random.Random(seed)
    base = [prose(rng, n) for n in (120, 80, 300, 40, 15, 3, 1)]
    passage = prose(rng, 70)
    out = [(k, x) for k, x in enumerate(base)]
    out += [(20, base[0]), (21, base[0] + " end"), (22, base[2].replace(" ", "  ", 3)), (23, base[0].upper())]
    near = base[2].split()
    near[100] = "changed"
    out += [(24, " ".join(near)), (25, prose(rng, 30) + "\n" + passage + "\n" + prose(rng, 30)), (26, passage + " " + prose(rng, 90))]
    out += [(30, None), (31, ""), (32, "   \n\t "), (33, "!!! ... ---"), (34, "é日本 漢字 Ünïcode ß́ 😀 x"), (35, "one two"), (36, "one two")]
    out += [(40, prose(rng, 30_000)), (41, "x" * 50_000), (50, base[1]), (50, base[1]), (-3, base[1] + " tail words here"), (None, base[0]), (None, None)]
    return out


def frame(spark, rows: list[tuple]):
    return spark.createDataFrame([(i, t, "en", "s", 7, "d", "f", "v", "s", "b", "l", "p", 1) for i, t in rows], SCHEMA)


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
