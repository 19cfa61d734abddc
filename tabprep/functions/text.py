"""Column functions on text: words, and seeded edits of words.

Every edit is one expression over (text, key): the same key, seed and salt give the same text
again. ``let`` keeps the word list from being split twice. What an edit needs from a dictionary
it takes from a column that a join has added (see ``operators.augment``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabprep.functions.seeded import below, pick, u
from tabprep.functions.vectors import let

# Unicode white space plus the four separator controls, as str.split() sees it
_SPACE = r"(?U)[\s\x1c-\x1f]+"


def words(text: Column) -> Column:
    """Words between white space of any kind; no empty ones. NULL text gives NULL."""
    return F.filter(F.split(text, _SPACE), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.when(text.isNotNull(), F.size(words(text)))


def choose(options: Column, draw: Column) -> Column:
    """One element by a draw in [0, 1); NULL from an empty or missing array."""
    return F.get(options, pick(F.size(options), draw))


def drawn_word(text: Column, key: Column, seed: int, salt: str) -> Column:
    """The random word of a text that ``replace_one`` or ``insert_synonym`` looks up."""
    return choose(words(text), u(seed, key, salt, "word"))


def replace_one(
    text: Column, key: Column, word: Column, synonyms: Column, seed: int, salt: str, every: bool = False
) -> Column:
    """Replace ``word``, as drawn, by one of its synonyms: its first occurrence as a substring, or every one."""
    new = choose(synonyms, u(seed, key, salt, "synonym"))
    if every:
        return F.coalesce(F.replace(text, word, new), text)
    return F.coalesce(F.overlay(text, new, F.position(word, text), F.length(word)), text)


def is_drawn(key: Column, at: Column, seed: int, salt: str, p: float) -> Column:
    """Whether ``replace_each`` may replace the word at a position."""
    return below(p, seed, key, salt, "word", at)


def other_synonym(word: Column, synonyms: Column, key: Column, at: Column, seed: int, salt: str) -> Column:
    """One of a word's synonyms other than itself, ``_`` read as a space; NULL without any."""
    others = F.filter(synonyms, lambda s: F.lower(s) != F.lower(word))
    return F.replace(choose(others, u(seed, key, salt, "synonym", at)), F.lit("_"), F.lit(" "))


def put_words(text: Column, new: Column) -> Column:
    """The text with the words at some positions replaced; ``new`` is an ordered array of (pos, word).

    The words between two positions are copied as one slice, so the work is linear in the text.
    """

    def edit(ws: Column) -> Column:
        def upto(r: Column, k: Column) -> Column:
            done = F.when(k == 0, 0).otherwise(F.get(new, k - 1)["pos"] + 1)
            return F.concat(F.slice(ws, done + 1, r["pos"] - done), F.array(r["word"]))

        done = F.coalesce(F.get(new, F.size(new) - 1)["pos"] + 1, F.lit(0))
        rest = F.slice(ws, done + 1, F.size(ws))
        return F.array_join(F.concat(F.flatten(F.transform(new, upto)), rest), " ")

    return F.when(text.isNotNull(), let(words(text), edit))


def delete_words(
    text: Column, key: Column, seed: int, salt: str, p: float = 0.1, min_words: int = 5
) -> Column:
    """Drop each word with chance ``p``; texts under ``min_words`` words stay."""

    def edit(ws: Column) -> Column:
        kept = F.filter(ws, lambda w, i: u(seed, key, salt, i) > p)
        return F.when(F.size(ws) < min_words, text).otherwise(F.array_join(kept, " "))

    return let(words(text), edit)


def insert_synonym(
    text: Column, key: Column, synonyms: Column, seed: int, salt: str, min_words: int = 5
) -> Column:
    """Insert one of the drawn word's synonyms at a random place; texts under ``min_words`` words stay."""

    def edit(ws: Column) -> Column:
        new = choose(synonyms, u(seed, key, salt, "synonym"))
        place = pick(F.size(ws) + 1, u(seed, key, salt, "place"))
        longer = F.concat(F.slice(ws, F.lit(1), place), F.array(new), F.slice(ws, place + 1, F.size(ws)))
        return F.when(F.size(ws) < min_words, text).otherwise(
            F.array_join(F.when(new.isNull(), ws).otherwise(longer), " ")
        )

    return let(words(text), edit)


def swap_words(text: Column, key: Column, seed: int, salt: str, p: float = 0.1) -> Column:
    """With chance ``p`` two random words change places; texts under two words stay."""

    def edit(ws: Column) -> Column:
        a = pick(F.size(ws), u(seed, key, salt, "a"))
        b = pick(F.size(ws) - 1, u(seed, key, salt, "b"))
        places = F.struct(a.alias("a"), F.when(b >= a, b + 1).otherwise(b).alias("b"))

        def swapped(at: Column) -> Column:
            return F.transform(
                ws,
                lambda w, i: F.when(i == at["a"], F.get(ws, at["b"]))
                .when(i == at["b"], F.get(ws, at["a"]))
                .otherwise(w),
            )

        changed = F.when(u(seed, key, salt, "gate") < p, let(places, swapped)).otherwise(ws)
        return F.when(F.size(ws) < 2, text).otherwise(F.array_join(changed, " "))

    return let(words(text), edit)


def letter_words(text: Column) -> Column:
    """Lower-case runs of letters."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: w != "")
