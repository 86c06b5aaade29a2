"""Small documents with the awkward cases, and brute-force counterparts."""

import re

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names the operators use inside.
CLASHING = {"block": "x", "bucket": 3, "score": 0.5, "component": 7, "sketch": "y", "start": 1, "u": 2, "label": "z"}

BASE = (
    "the quick brown fox jumps over the lazy dog near the river bank while seven old owls watch from the tall pine "
    "and nobody in the quiet village hears the slow bell that rings at noon every second day of the long warm month"
)


def texts() -> list[tuple]:
    long = " ".join(f"w{i} zebra{i % 7}" for i in range(4000))
    rows = [
        (0, BASE),
        (1, BASE),  # an exact copy
        (2, BASE + " indeed"),  # a near copy
        (3, BASE.upper()),
        (4, None),
        (5, ""),
        (6, " \n\t "),
        (7, "two words"),
        (8, "two words"),
        (9, "über straße naïve café " * 30),
        (10, long),
        (11, long + " tail"),
        (12, "same same same " * 40),
        (13, "漢字かな交じり文。" * 20),
        (14, "x" * 3000),
        (15, "12345 !!! ???"),
        (16, BASE[:120] + " something else entirely follows here " + BASE[60:]),
        (17, "line one has words\nline one has words\n\nline two differs\n" * 3),
        (18, "a <|endoftext|> b <s> </s> c"),
        (2**60, BASE.replace("owls", "crows")),
    ]
    return [(i, t, "en" if i % 2 else "de", f"src{i % 3}", len(t) if t is not None else None) for i, t in rows]


def documents(spark, rows=None, clash: bool = False):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(texts() if rows is None else rows, DOC_SCHEMA)
    if clash:
        for name, value in CLASHING.items():
            df = df.withColumn(name, F.lit(value))
    return df


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, k):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(text)]
    if len(w) >= k:
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
    return {tuple(w)} if w else set()


def components(rows, k, percent):
    """{doc_id: (set size, smallest linked id)} by comparing all pairs."""
    sets = {r[0]: shingles(r[1], k) for r in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y]:
                both = len(sets[x] & sets[y])
                if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                    a, b = find(x), find(y)
                    root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def repeats(rows, length):
    """{doc_id: (bytes, removed, spans, kept)} from a table of all windows."""
    first = {}
    for i, t, *_ in sorted(rows, key=lambda r: r[0]):
        data = (t or "").encode()
        for p in range(len(data) - length + 1):
            first.setdefault(data[p : p + length], i)
    out = {}
    for i, t, *_ in rows:
        data = (t or "").encode()
        lost = [False] * len(data)
        for p in range(len(data) - length + 1):
            if first[data[p : p + length]] < i:
                lost[p : p + length] = [True] * length
        runs = sum(1 for p in range(len(data)) if lost[p] and (p == 0 or not lost[p - 1]))
        out[i] = (len(data), sum(lost), runs, bytes(b for b, x in zip(data, lost) if not x))
    return out
