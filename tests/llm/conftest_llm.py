"""Helpers of the tests of the corpus operators."""

import re

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Columns that the operators use inside, as extra columns of an input.
CLASHING = "mark cid n band bands sketch key whole first last open spans kept size target taken upto rank label surprise".split()


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def prose(rng, n, vocabulary=400):
    """``n`` words, some long and some not ASCII, with line breaks."""
    return " ".join(f"w{rng.randrange(vocabulary)}{rng.choice(['', 'é', 'ß', '.', '\n'])}" for _ in range(n))
