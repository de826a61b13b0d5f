"""Character and word error rates without Python: Spark's own Levenshtein distance.

Words become single characters of an alphabet, by their place in the list of the row's distinct words, so that the
distance counts words. Against an empty reference the rate is 0 for an empty hypothesis and else the number of
inserted units, as if the reference had one unit.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Code points without case or composition: Han, Hangul, then a supplementary plane of Han.
ALPHABET = "".join(map(chr, [*range(0x4E00, 0x9FA6), *range(0xAC00, 0xD7A4), *range(0x20000, 0x2A6D0)]))


def _rate(distance: Column, units: Column) -> Column:
    return distance.cast("double") / F.greatest(units, F.lit(1)).cast("double")


def character_error_rate(reference: Column, hypothesis: Column) -> Column:
    return _rate(F.levenshtein(reference, hypothesis), F.length(reference))


def words(text: Column) -> Column:
    """What white space separates; an empty array for an empty text."""
    return F.filter(F.split(F.trim(text), r"(?U)\s+"), lambda w: w != "")


def word_error_rate(reference: Column, hypothesis: Column) -> Column:
    """Null for nulls, and for a row of more distinct words than ALPHABET has characters."""
    ref, hyp = words(reference), words(hypothesis)
    row = F.struct(ref.alias("r"), hyp.alias("h"), F.array_distinct(F.concat(ref, hyp)).alias("known"))

    def rate(x: Column) -> Column:
        def coded(w: Column) -> Column:
            return F.array_join(F.transform(w, lambda y: F.substr(F.lit(ALPHABET), F.array_position(x["known"], y).cast("int"), F.lit(1))), "")

        distance = F.when(F.size(x["known"]) <= len(ALPHABET), F.levenshtein(coded(x["r"]), coded(x["h"])))
        return _rate(distance, F.size(x["r"]))

    # as the variable of a function over one element, the lists of words are made once a row and not once a word
    return F.when(reference.isNotNull() & hypothesis.isNotNull(), F.get(F.transform(F.array(row), rate), F.lit(0)))
