"""Inputs that the tests of this folder share."""

from __future__ import annotations

import random

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside, as columns of the input.
CLASHING = ("key", "fp", "fingerprint", "n", "keep_id", "blob", "entry_id", "entry", "hash", "chunk", "spans", "root", "component_id", "kept", "sha", "id", "far", "held_out", "score", "ids", "k", "pieces", "body", "u", "v", "row", "pair", "stays", "may", "at", "digest", "node", "__lang", "__id", "__sha", "__n", "__blob", "__spans", "__masked", "__gone")

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n))


def odd_rows() -> list[tuple]:
    """Null and empty texts, a null identifier, ties, repeated rows, a very long text, and one hot group of copies."""
    rng = random.Random(7)
    long = ". ".join(sentence(rng, 12) for _ in range(2500))
    texts = [None, "", None, "", "A", "a", "Same text here.\nSame text here.", "same TEXT here.\nSame text here.", "été ÉTÉ", "ÉTÉ été", long, long.upper(), "  \t\n ", "!!! ???", "中文 text ٣"]
    rows = [(i, x) for i, x in enumerate(texts)]
    rows += [(100 + i, "one of many copies, all of which say the same few words") for i in range(20)]
    rows += [(200 + i, "\n".join([sentence(rng, 8), "shared line", sentence(rng, 8)])) for i in range(15)]
    rows += [(4, "A"), (4, "A"), (5, "other text of one identifier"), (None, "A"), (None, None), (None, "lone text")]
    return [(i, x, None if x is None or k % 5 == 0 else "en", f"s{k % 3}", None if x is None else len(x)) for k, (i, x) in enumerate(rows)]


def rows_of(df, *columns):
    return sorted((tuple(x) for x in (df.select(*columns) if columns else df).collect()), key=repr)
