"""Line-first cleaning: rules per line, failing lines removed, then documents that lost too much rejected.

A line is a part between ``\\n``; words are runs without ASCII blanks. A line with a word fails if

* *punctuation*: its last word has no terminal mark, or it holds more than 3 symbols of ``#*$%&|<>`` per
  10 words;
* *navigation*: it is a row of short labels parted by ``|``, ``»`` or ``>``, or it is a navigation phrase;
* *boilerplate*: it holds a boilerplate phrase.

Lines without a word pass. A document is rejected if failing lines held over 30 % of its words, or by
the base rules: under 50 words, or over half of its words in 3-word windows that occur twice or more.

Edge cases: a null text counts as an empty one (no words: rejected); rows are judged one by one, so
repeated rows get equal verdicts; other columns are ignored by ``judge`` and kept by ``clean``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import ship_package

# fixed values of the rules (ASCII case is ignored in phrases)
SYMBOLS = "#*$%&|<>"
TERMINAL = ".!?…。！？"
CLOSING = "\"'”’»)]"
NAVIGATION = (
    "home", "menu", "next", "previous", "back to top", "skip to content", "read more", "sign in", "log in", "share this", "contact us", "about us",
    "startseite", "weiter", "zurück", "nach oben", "zum inhalt springen", "weiterlesen", "anmelden", "kontakt", "über uns",
    "accueil", "suivant", "précédent", "haut de page", "aller au contenu", "lire la suite", "se connecter", "contactez-nous", "qui sommes-nous",
    "inicio", "menú", "siguiente", "anterior", "volver arriba", "ir al contenido", "leer más", "iniciar sesión", "contacto", "quiénes somos",
)
BOILERPLATE = (
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "use cookies", "enable javascript", "lorem ipsum", "subscribe to our newsletter",
    "alle rechte vorbehalten", "nutzungsbedingungen", "datenschutzerklärung", "cookie-richtlinie", "verwendet cookies", "javascript aktivieren", "newsletter abonnieren",
    "tous droits réservés", "conditions générales", "politique de confidentialité", "politique de cookies", "utilise des cookies", "activer javascript",
    "todos los derechos reservados", "términos de uso", "política de privacidad", "política de cookies", "utiliza cookies", "activar javascript",
)
MAX_LOST_PERCENT, MIN_WORDS, MAX_REPEAT_PERCENT, MAX_SYMBOLS_PER_10_WORDS = 30, 50, 50, 3

_SYMBOL = str.maketrans("", "", SYMBOLS)
_BLANK = bytes([32, *range(9, 14)])
_BOILERPLATE = re.compile("|".join(map(re.escape, BOILERPLATE)))
#: Possessive, as blanks that fit two parts would be tried in every combination; equal to the plain pattern in ``sql``.
_LABELS = re.compile(r"(?:(?=[^|»>])[ \t]*+[^|»>]{0,20}+[|»>]){2,}+[^|»>]{0,20}")


def line_passes(line: str, n_words: int) -> bool:
    """Verdict on one line, given how many words it holds."""
    if not n_words:
        return True
    text = line.strip(" \t\n\r\x0b\x0c")
    ending = text.rstrip(CLOSING) or text
    if ending[-1] not in TERMINAL:
        return False
    if 10 * (len(text) - len(text.translate(_SYMBOL))) > MAX_SYMBOLS_PER_10_WORDS * n_words:
        return False
    lower = text.lower()
    return not (lower.rstrip(TERMINAL) in NAVIGATION or _BOILERPLATE.search(lower) or _LABELS.fullmatch(text))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window which occurs twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    if len(number) == n:
        return 0
    size = len(number)
    if size < 2_000_000:
        windows = (ids[:-2] * size + ids[1:-1]) * size + ids[2:]
        _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    else:
        triples = np.stack([ids[:-2], ids[1:-1], ids[2:]], axis=1)
        _, inverse, counts = np.unique(triples, axis=0, return_inverse=True, return_counts=True)
    twice = counts[inverse.reshape(-1)] > 1
    inside = np.zeros(n, bool)
    inside[:-2] |= twice
    inside[1:-1] |= twice
    inside[2:] |= twice
    return int(inside.sum())


def judge_text(text: str | None) -> tuple[tuple, str]:
    """((n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept), cleaned text)."""
    text = text or ""
    words, seen, passed = [], set(), []
    duplicates = lost = 0
    for line in text.split("\n"):
        own = line.encode("utf-8", "surrogatepass").split()
        if own:
            duplicates += line in seen
            seen.add(line)
            words += own
        if line_passes(line, len(own)):
            passed.append(line)
        else:
            lost += len(own)
    n = len(words)
    chars = len(text) - sum(text.count(chr(b)) for b in _BLANK)
    symbols = len(text) - len(text.translate(_SYMBOL))
    repeated = repeated_words(words)
    failed = n < MIN_WORDS or 100 * repeated > MAX_REPEAT_PERCENT * n
    kept = not failed and 100 * lost <= MAX_LOST_PERCENT * n
    return (n, chars, symbols, duplicates, repeated, failed, kept), "\n".join(passed)


_NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
_TYPES = [pa.int64()] * 5 + [pa.bool_()] * 2


def judge(docs: DataFrame) -> DataFrame:
    """Per row of (doc_id, text): doc_id, the counts and the verdict."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [judge_text(t.as_py())[0] for t in batch.column(1)]
            columns = zip(*rows, strict=True) if rows else [[]] * len(_NAMES)
            made = [pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], ["doc_id", *_NAMES])

    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = ", ".join(f"{n} {'long' if t == pa.int64() else 'boolean'}" for n, t in zip(_NAMES, _TYPES, strict=True))
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {fields}")


def clean(docs: DataFrame) -> DataFrame:
    """The kept rows of ``docs``, texts without their failing lines; n_chars follows where it exists."""
    ship_package(docs.sparkSession)
    at, schema = docs.columns.index("text"), docs.schema
    length = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [judge_text(t.as_py()) for t in batch.column(at)]
            keep = pa.array([r[0][-1] for r in rows], pa.bool_())
            columns = [c.filter(keep) for c in batch.columns]
            texts = [r[1] for r in rows if r[0][-1]]
            columns[at] = pa.array(texts, columns[at].type)
            if length is not None:
                columns[length] = pa.array(list(map(len, texts)), columns[length].type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return docs.mapInArrow(run, schema)


def sql() -> str:
    """``judge`` in DuckDB SQL."""
    quoted = lambda t: re.escape(t).replace("'", "''").replace("/", "/")
    blank = r"[\x20\x09-\x0D]"
    word = r"[^\x20\x09-\x0D]+"
    closing, terminal = "".join(map(quoted, CLOSING)), "".join(map(quoted, TERMINAL))
    symbols = f"[{re.escape(SYMBOLS)}]"
    navigation = ", ".join(f"'{t}'" for t in NAVIGATION)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, line, i, len(regexp_extract_all(line, '{word}')) AS n,
  regexp_replace(line, '^{blank}+|{blank}+$', '', 'g') AS t
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d)),
v AS (SELECT *, n > 0 AND (
    NOT regexp_matches(CASE WHEN regexp_replace(t, '[{closing}]+$', '') = '' THEN t ELSE regexp_replace(t, '[{closing}]+$', '') END, '[{terminal}]$')
    OR 10 * len(regexp_extract_all(t, '{symbols}')) > {MAX_SYMBOLS_PER_10_WORDS} * n
    OR regexp_replace(lower(t), '[{terminal}]+$', '') IN ({navigation})
    OR regexp_matches(lower(t), '{"|".join(map(quoted, BOILERPLATE))}')
    OR regexp_full_match(t, '([ \\t]*[^|»>]{{1,20}}[|»>]){{2,}}[^|»>]{{0,20}}')) AS fails,
  n > 0 AND row_number() OVER (PARTITION BY doc_id, line ORDER BY i) > 1 AS again FROM l),
s AS (SELECT doc_id, sum(n)::BIGINT AS n_words, count_if(again)::BIGINT AS n_dup_lines, coalesce(sum(n) FILTER (fails), 0) AS lost FROM v GROUP BY doc_id),
w AS (SELECT doc_id, regexp_extract_all(text, '{word}') AS ws FROM d),
x AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, unnest(list_zip(ws[:-3], ws[2:-2], ws[3:])) AS tri FROM w WHERE len(ws) > 2),
y AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, tri) AS c FROM x),
z AS (SELECT doc_id, count(DISTINCT j)::BIGINT AS r FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM y WHERE c > 1) GROUP BY doc_id),
a AS (SELECT d.doc_id, n_words, len(regexp_replace(text, '{blank}', '', 'g'))::BIGINT AS word_chars,
  len(regexp_extract_all(text, '{symbols}'))::BIGINT AS n_symbols, n_dup_lines, coalesce(r, 0)::BIGINT AS n_repeat_words, lost
  FROM d JOIN s USING (doc_id) LEFT JOIN z USING (doc_id)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * lost <= {MAX_LOST_PERCENT} * n_words AS kept FROM b"""
