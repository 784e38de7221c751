"""Small tables with the cases that every operator must stand."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Extra columns whose names operators use inside.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, id string, key string, size string, "
          "row string, score string")
CLASH = ("a", "b", "c", "d", "e")


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return WORD.findall(fold(text))


def sentence(rng, n):
    return " ".join(rng.choice("abcdefghijklmnop") + str(rng.randrange(400)) for _ in range(n))


def texts(seed=1):
    """Plain texts, exact and near copies, shared passages, empty, null and very long ones."""
    rng = random.Random(seed)
    plain = [sentence(rng, rng.randint(5, 150)) for _ in range(40)]
    near = []
    for base in plain[:6]:
        for _ in range(4):
            w = base.split()
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] = "edited"
            near.append(" ".join(w))
    passage = sentence(rng, 70)
    shared = [sentence(rng, rng.randint(0, 40)) + "\n" + passage + " " + sentence(rng, rng.randint(0, 40)) for _ in range(6)]
    return plain + near + shared + plain[3:6] + [
        "", "   ", None, None, "one", "one two", "ONE TWO", "x " * 500, sentence(rng, 6000), "ünï cödé  ïs here", "\n\n"]


def rows(seed=1):
    out = [(i, t, "en", None if i % 7 == 0 else f"s{i % 5}", len(t or ""), *CLASH) for i, t in enumerate(texts(seed))]
    return out + [out[3], out[3]]  # repeated rows


def documents(spark, some=None):
    return spark.createDataFrame(rows() if some is None else some, SCHEMA)
