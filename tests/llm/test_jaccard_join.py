import random
import re

from quirework.llm.jaccard_join import jaccard_components

SCHEMA = "doc_id long, text string"


def brute(rows):
    """Every pair of sets, compared as sets of word tuples."""
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    sets = {}
    for doc, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        sets[doc] = {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} - {()}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = dict.fromkeys(sets, 0)
    docs = sorted(sets)
    for i, a in enumerate(docs):
        for b in docs[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {d: (len(sets[d]), find(d), links[d]) for d in docs}


def got(frame):
    return {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in frame.collect()}


def corpus(seed, groups, spread):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    rows, doc = [], 0
    line = rng.choices(words, k=13)
    for size in groups:
        base = rng.choices(words, k=rng.choice((6, 30, 120, 300)))
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randrange(spread)):
                text[rng.randrange(len(text))] = rng.choice(words)
            if rng.random() < 0.4:
                text = line + text
            rows.append((doc * 7 % 100_003, " ".join(text)))
            doc += 1
    return rows


def test_equals_brute_force(spark):
    rows = corpus(1, [1] * 40 + [2, 3, 5, 8] * 4 + [60], 6)
    rows += [(900_001, None), (900_002, ""), (900_003, " \t\n"), (900_004, "Alone"), (900_005, "alone"), (900_006, "four words are here"), (900_007, "Äpfel Äpfel"), (900_008, "äpfel äpfel")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(jaccard_components(frame)) == brute(rows)


def test_small_blocks_and_many_ranges_change_nothing(spark, monkeypatch):
    import quirework.llm.jaccard_join as j

    rows = corpus(2, [150, 90], 9)
    frame = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows)
    assert got(jaccard_components(frame)) == want
    for name, value in (("BLOCK_LEAST", 7), ("BLOCK_DOCS", 11), ("HOT", 3), ("RANGE_CHARS", 500), ("PACK_TOKENS", 300)):
        monkeypatch.setattr(j, name, value)
    assert got(jaccard_components(frame)) == want


def test_a_document_of_a_large_family_goes_out_few_times(spark):
    """Each document of a cell of 20 000 meets eight blocks: its own one among them."""
    import quirework.llm.jaccard_join as j

    rows = spark.range(20_000).selectExpr("5L as home", "3 as class", "id as doc_id", "1L as copies", "9 as n", "2 as prefix", "array(id, 7L) as tokens")
    near = spark.createDataFrame([], "low_home long, low_class int, high_home long, high_class int")
    met = j._met(rows, near)
    sent = met.groupBy("doc_id").count().selectExpr("max(count)", "min(count)").first()
    assert tuple(sent) == (8, 8) and met.select("meet", "more").distinct().count() == 36


def test_a_shared_passage_does_not_hide_links(spark):
    """A passage that stands in all documents, long and short ones, and a text of a megabyte with a near copy."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(5000)]
    passage = rng.choices(words, k=40)
    rows = []
    for d in range(120):
        own = rng.choices(words, k=rng.choice((2, 6, 9, 40)))
        rows.append((d, " ".join(passage + own)))
        if d % 3 == 0:
            rows.append((1000 + d, " ".join(passage + own[:-1] + ["x"])))
    long = rng.choices(words, k=180_000)
    rows += [(5000, " ".join(long)), (5001, " ".join([*long[:-9], "y"]))]
    assert got(jaccard_components(spark.createDataFrame(rows, SCHEMA).repartition(3))) == brute(rows)


def test_one_text_of_a_repeated_id_counts(spark):
    """Of an id's texts the one of fewest shingles; digest and size come from that one text."""
    short, long = "a b c d e f g h", "k l m n o p q r s t u v"
    rows = [(1, long), (1, short), (2, short), (3, long)]
    assert got(jaccard_components(spark.createDataFrame(rows, SCHEMA))) == {1: (4, 1, 1), 2: (4, 1, 1), 3: (8, 3, 0)}


def test_repeated_rows_extra_columns_and_empty_table(spark):
    rows = [(1, "a b c d e f", 5), (1, "a b c d e f", 5), (2, "a b c d e f", 6), (None, "a b c d e f", 7)]
    frame = spark.createDataFrame(rows, SCHEMA + ", token long")
    assert got(jaccard_components(frame)) == {1: (2, 1, 1), 2: (2, 1, 1)}
    assert got(jaccard_components(frame.limit(0))) == {}


def test_texts_of_a_megabyte(spark):
    """Two long near copies, one that shares half of them, and a long text of one word."""
    words = [f"word{i}" for i in range(120_000)]
    rows = [(4, " ".join(words)), (2, " ".join(words[:-500])), (3, " ".join(words[:60_000])), (9, "same " * 200_000), (1, None)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {4: (119_996, 2), 2: (119_496, 2), 3: (59_996, 3), 9: (1, 9), 1: (0, 1)}
