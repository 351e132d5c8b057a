"""Small documents with every awkward case, and what the operators are compared with."""

from __future__ import annotations

import random
import re
import zlib

SPACE = r"[^\x20\x09-\x0D]+"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng: random.Random, n: int, words=None) -> list[str]:
    words = words or [a + b for a in ("the", "on", "er", "an", "re", "tion", "sh", "ou") for b in ("", "th", "ing", "ly", "ed", "st")]
    return [rng.choice(words) + ("." if rng.random() < 0.1 else "") for _ in range(n)]


def sentence_text(rng: random.Random, n: int) -> str:
    out = prose(rng, n)
    return "".join(w + (rng.choice(["\n", "  ", " "]) if rng.random() < 0.1 else " ") for w in out).strip()


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text: str | None) -> list[str]:
    return re.findall(SPACE, text or "")


def sample(seed: int = 3, n: int = 120) -> list[tuple]:
    """Documents with copies, near copies, shared passages, junk, nulls, ties, empty and long texts."""
    rng = random.Random(seed)
    rows: list[tuple] = []
    passage = " ".join(prose(rng, 70))

    def add(text, lang="en", source="s"):
        rows.append((len(rows), text, lang, source, None if text is None else len(text)))

    base = [sentence_text(rng, rng.choice([3, 12, 60, 150, 400])) for _ in range(n)]
    for text in base:
        add(text)
    for text in base[:15]:
        add(text)
        own = text.split(" ")
        own[len(own) // 2] = "changed"
        add(" ".join(own))
    for k in range(12):
        add(sentence_text(rng, 20 * k) + " " + passage + " " + sentence_text(rng, 30))
    for text in (None, "", " \t\n ", "###", "one", "Two words", "ÉÉ ñandú\x0bvertical", "    x", "🙂 emoji 🙂", "same " * 400):
        add(text, None)
        add(text, "fr")
    add(sentence_text(rng, 4000))
    rows.append((None, base[0], "en", None, 1))
    rows.append((None, None, None, None, None))
    rows.append(rows[5])
    rows.append((rows[6][0], rows[7][1], "en", "s", 1))
    return rows


def clashing(df):
    """The same rows with extra columns named as the operators name theirs."""
    extra = "fp text_key bucket component_id score kept rate p spans g q lo n first_id node root word words start part label good copies".split()
    for name in extra:
        df = df.selectExpr("*", f"'x' as {name}")
    return df


def part(doc_id, parts: int) -> int | None:
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % parts
