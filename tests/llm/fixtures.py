"""Small tables with what real ones hold: nulls, empty and long texts, ties, repeated rows, clashing column names."""

import random

SCHEMA = "doc_id long, text string, row string, id long, block int, key string, bits long, n_chars int"


def prose(seed, words, alphabet=("the", "of", "and", "in", "on", "er", "th", "ation", "ing", "ent", "ha", "onder", "Blé", "Größe,", "x.")):
    r = random.Random(seed)
    return " ".join(r.choice(alphabet) + r.choice(("", "s", "ed", str(r.randrange(9)))) for _ in range(words))


def texts():
    passage = prose("passage", 60)
    line = "All rights reserved by the owners of this page, who may be asked for more by letter or telephone at any time. " \
           "Nothing here may be copied without asking first, and that holds for every single part of this page as well as all."
    out = [prose(i, 20 + 17 * i % 90) for i in range(30)]
    out += [out[3], out[3], out[5] + " tail", "head " + out[5]]  # exact and near copies
    out += [prose(f"a{i}", 12) + " " + passage + " " + prose(f"b{i}", 8) for i in range(6)]
    out += [prose(f"c{i}", 15) + "\n" + line + "\n" + prose(f"d{i}", 9) for i in range(25)]
    out += [None, None, "", "   \t\n ", "A", "!!! *** 123", "é", "one two", "a" * 700, "ab" * 400, "z " * 300, "日本語の文章です " * 20, "\0nul\0 here"]
    out += [prose("long", 6000)]
    return out


def rows():
    found = [(i * 7 % 1000, t, "r", -i, i % 3, "k", i, None if t is None else len(t)) for i, t in enumerate(texts())]
    found += [found[4], found[8], (None, "no id at all " * 15, "r", 1, 1, "k", 1, 1), (None, None, None, None, None, None, None, None)]
    return found


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
