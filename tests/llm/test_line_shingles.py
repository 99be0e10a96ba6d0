from tablesmith.llm import lines
from tests.llm.test_lines import docs  # noqa: F401


def full(line):
    return {line[k : k + 8] for k in range(max(1, len(line) - 7))}


def brute(texts):
    at = sorted((d, n, x) for d, text in texts for n, x in enumerate((text or "").split("\n")) if x.strip("\t\n\x0b\x0c\r "))
    label, sets = list(range(len(at))), [full(x) for _, _, x in at]
    for i in range(len(at)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return {(d, n): at[label[i]][:2] for i, (d, n, _) in enumerate(at)}


def classes(spark, texts):
    rows = lines.line_classes(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    return {(r["doc_id"], r["line_no"]): (r["keep_doc_id"], r["keep_line_no"]) for r in rows}


def test_classes_match_brute_force_over_all_shingles(spark, docs):  # noqa: F811
    texts = docs + [(106, "naïve café über straße " * 3), (107, "naïve café über straße " * 3 + "😀")]
    assert classes(spark, texts) == brute(texts)


def test_words_ends_count_as_much_as_their_starts(spark):
    # Every eighth letter on from a word's start is the same, the ends of the long words are not.
    heads = ["abcdefgh", "bcdefghi", "cdefghij", "defghijk", "efghijkl", "fghijklm", "ghijklmn", "hijklmno"]
    texts = [(d, " ".join(f"{h}{tail * 12}{k}" for k, h in enumerate(heads))) for d, tail in ((1, "xy"), (2, "zw"))]
    assert classes(spark, texts) == {(1, 0): (1, 0), (2, 0): (2, 0)}


def test_lists_of_addresses_with_a_common_head_stay_apart(spark):
    # Six or more words that all begin alike, as in lists of links: only what follows tells the lines apart.
    urls = [" ".join(f"https://{host}{k}.{host}.org/{k * 977 % 89}" for k in range(n)) for n, host in ((7, "alpha"), (9, "bravo"), (20, "cedar"))]
    assert classes(spark, list(enumerate(urls))) == {(d, 0): (d, 0) for d in range(3)}


def test_lines_of_few_different_shingles_are_found(spark):
    # Long lines whose hashes below the bound fill few parts are signed by all of them.
    texts = [(1, "ab" * 4000), (2, "ab" * 3900), (3, "x" * 9000), (4, "x" * 700), (5, "pattern of words, " * 300), (6, "pattern of words, " * 280)]
    assert classes(spark, texts) == brute(texts) == {(1, 0): (1, 0), (2, 0): (1, 0), (3, 0): (3, 0), (4, 0): (3, 0), (5, 0): (5, 0), (6, 0): (5, 0)}


def test_lines_of_documents_without_an_id(spark):
    rows = lines.line_classes(spark.createDataFrame([(None, "one line here"), (None, "one line here"), (2**62, "two"), (None, "two"), (-5, "two")], "doc_id long, text string")).collect()
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, [(None, 0, None, 0, True)] * 2 + [(2**62, 0, -5, 0, False), (None, 0, -5, 0, False), (-5, 0, -5, 0, True)]))
