import hashlib
import re

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "chunk string, shard string, row string, key string, rank string, fp string")  # names the operators use


def frame(spark, rows):
    full = [(i, t, lang, src, len(t or ""), "x", "x", "x", "x", "x", "x") for i, t, lang, src in rows]
    return spark.createDataFrame(full, SCHEMA)


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def split_words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def alnum_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", ascii_lower(text or ""))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
