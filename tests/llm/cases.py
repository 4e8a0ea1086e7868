"""Awkward documents for the operators' tests: nulls, empty and very long texts, copies, near copies, clashing columns."""

import random
import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, words string, size string, position string, key string"
GAP = re.compile(r"[^\x20\x09-\x0D]+")
VOCAB = ["".join(random.Random(i).choices("abcdefghijklmnopqrstuvwxyzéü", k=random.Random(i).randint(1, 8))) for i in range(900)]


def text_of(rng, n, lines=True):
    out = []
    for _ in range(n):
        out.append(rng.choice(VOCAB))
        out.append(rng.choice([" ", " ", " ", "\n" if lines else " ", "  ", "\t"]))
    return "".join(out)


def documents(seed=7, n=60):
    rng = random.Random(seed)
    passage, line = text_of(rng, 50), text_of(rng, 12, False)
    rows = []
    for i in range(n):
        text = text_of(rng, rng.choice([1, 3, 20, 40, 80, 150, 300]))
        if i % 4 == 1:
            text = text + passage + text_of(rng, 20)
        if i % 3 == 1:
            text = text + line
        rows.append([i, text, rng.choice(["de", "en", None]), rng.choice(["s0", "s0", "s1", None])])
    base = text_of(rng, 220)
    for k in range(25):
        parts = base.split(" ")
        for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
            parts[rng.randrange(len(parts))] = rng.choice(VOCAB)
        rows.append([100 + k, " ".join(parts), "en", "s0"])
    rows += [[200 + k, rows[5][1], "en", "s2"] for k in range(6)]
    rows += [[300, None, "en", "s0"], [301, "", "de", None], [302, " \n\t ", None, "s1"], [303, "x", "de", "s1"], [304, "x", "de", "s1"], [305, "a b", "en", "s1"]]
    rows += [[400, text_of(rng, 30_000), "en", "s0"], [401, ("lo rem ip sum " * 400), "en", "s1"], [402, "ab " * 37 + "cd " + "ab " * 36, "de", "s1"]]
    rows += [[403, "z" * 40_000, "en", "s0"], [404, " é ü 12 $$ ## gpl", "en", "s0"], [405, "12 34 !!", "en", "s0"]]
    return [(i, t, lang, src, len(t or ""), i % 3, "w", "s", "p", "k") for i, t, lang, src in rows]


def words(text):
    return GAP.findall(text or "")
