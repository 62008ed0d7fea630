"""Direct versions of what the operators compute, over lists of Python values."""

from collections import Counter

ODD_TEXTS = [None, "", " \t\n", "\n\n\n", "word", "a b c d e f", "word", "x " * 30_000, "é" * 5_000, "Straße ñandú 漢字 \U0001f600"]
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASHING = "id long, n long, score double, kept boolean, pos int, key string, component_id long, lines int, copy int, rate double"


def documents(spark, rows):
    """A documents table with columns whose names operators use inside; `rows` holds (doc_id, text, source)."""
    full = [(i, t, "en", s, None, 1, None, 2.5, True, 3, "k", 4, 5, 6, None) for i, t, s in rows]
    return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, n_chars long, {CLASHING}")


def shingles(text, width):
    import re

    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    width = min(width, len(words))
    return frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1)) if width else frozenset()


def near_groups(docs, width, percent):
    """{doc_id: smallest doc_id reachable} by comparing all pairs; `docs` holds (doc_id, text)."""
    sets = {i: shingles(t, width) for i, t in docs}
    group = {i: i for i in sets}

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    ids = sorted(i for i in sets if sets[i])
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            a, b = sets[i], sets[j]
            if 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)):
                common = len(a & b)
                if 100 * common >= percent * (len(a) + len(b) - common):
                    x, y = root(i), root(j)
                    group[max(x, y)] = min(x, y)
    return {i: root(i) for i in sets}


def without_repeats(docs, size=3):
    """{doc_id: text} after line dedup; `docs` holds (doc_id, text) with distinct ids."""
    first, gone = {}, Counter()
    for i, text in sorted(docs):
        lines = (text or "").split("\n")
        for p in range(len(lines) - size + 1):
            window = tuple(lines[p : p + size])
            if any(x.strip(" ") for x in window):
                if window in first:
                    gone.update((i, p + k) for k in range(size))
                first.setdefault(window, (i, p))
    return {
        i: t if not any((i, p) in gone for p in range(len((t or "").split("\n")))) else "\n".join(
            x for p, x in enumerate(t.split("\n")) if (i, p) not in gone
        )
        for i, t in docs
    }
