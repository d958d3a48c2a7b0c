"""Language columns: distinct tokens against small hint sets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobsluice.functions.binding import bind

LANGUAGES = ("fr", "en", "de", "it")

# Hint words and token patterns of the French-or-English test. Its
# tokens keep accents.
ACCENTED_TOKEN = "[a-zàâçéèêëîïôûùüÿñæœ]{3,}"
ACCENTED_HINTS = {
    "fr": (
        "avec pour poste vous nous experience expérience equipe équipe mission competences compétences "
        "formation travail emploi profil francais français responsable gestion assurer recherche candidat"
    ).split(),
    "en": "with for you team experience job position skills work english required".split(),
    "de": "mit für sie erfahrung stelle aufgaben kenntnisse arbeit deutsch".split(),
    "it": "con per lavoro posizione esperienza richiesto competenze squadra".split(),
}

# The same for the French test. Its tokens are plain ASCII, an
# accent ends a token.
PLAIN_TOKEN = "[a-zA-Z]{3,}"
PLAIN_HINTS = {
    "fr": (
        "avec pour poste vous nous experience equipe mission competences formation travail emploi profil "
        "francais responsable gestion assurer recherche candidat"
    ).split(),
    "en": "with for you team experience job position skills work english".split(),
    "de": "mit fur sie erfahrung stelle aufgaben kenntnisse arbeit deutsch".split(),
    "it": "con per lavoro posizione esperienza richiesto competenze squadra".split(),
}


def hint_words(title: Column, description: Column, pattern: str, hints: dict[str, list[str]]) -> Column:
    """The hint words of any language among the lower-case tokens, each once."""
    joined = F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(description, F.lit("")))
    tokens = F.regexp_extract_all(F.lower(joined), F.lit(pattern), F.lit(0))
    return F.array_intersect(tokens, _words(sorted({w for words in hints.values() for w in words})))


def _words(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words])


def hint_counts(found: Column, hints: dict[str, list[str]]) -> Column:
    """struct<fr,en,de,it>: hint words found per language."""
    return F.struct(*[F.size(F.array_intersect(found, _words(hints[code]))).alias(code) for code in LANGUAGES])


def mostly_french_or_english(hits: Column) -> Column:
    enough = (hits["fr"] >= 2) | (hits["en"] >= 2)
    return enough & (F.greatest(hits["fr"], hits["en"]) >= F.greatest(hits["de"], hits["it"]))


def mostly_french(hits: Column) -> Column:
    return (hits["fr"] >= 2) & (hits["fr"] >= F.greatest(hits["en"], hits["de"], hits["it"]))


def reads_as_french_or_english(title: Column, description: Column) -> Column:
    found = hint_words(title, description, ACCENTED_TOKEN, ACCENTED_HINTS)
    return bind(bind(found, lambda w: hint_counts(w, ACCENTED_HINTS)), mostly_french_or_english)


def reads_as_french(title: Column, description: Column) -> Column:
    found = hint_words(title, description, PLAIN_TOKEN, PLAIN_HINTS)
    return bind(bind(found, lambda w: hint_counts(w, PLAIN_HINTS)), mostly_french)
