"""Sections are cut by patterns that run once for a text, and gaps are collapsed as before."""

import re

import pytest
from pyspark.sql import functions as F

from attestra.functions import text as T


@pytest.mark.parametrize(("kind", "name", "times"), [("abstract", "regexp_extract", 1), ("budget", "regexp_extract", 2), ("keywords", "split", 2)])
def test_a_pattern_stands_once_in_a_section(spark, kind, name, times):
    assert len(re.findall(rf"\b{name}\(", str(T.section_text(kind, "t")))) == times


def test_collapsed_gaps_are_those_of_every_white_space(spark):
    gaps = [" ", "  ", "\n", " \n", "\n ", "\t\t", " ", "  ", "　 ", "\x85", "   ", "\x1c", " \x1c "]
    texts = [f"{g}a{g}b c{g}{h}d{h}" for g in gaps for h in gaps] + ["", " ", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.filter(~T.collapse("t").eqNullSafe(F.trim(F.regexp_replace("t", T.WORD_GAP, " ")))).count() == 0
