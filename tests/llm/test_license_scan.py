"""License scan: notices planted in prose, with and without changes."""
from eventide.llm import op2_license_scan as op2

SCHEMA = "doc_id long, text string, license string, start long, confirmed string"
PROSE = "The quick words of some story go on here and there without an end. " * 3


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "l", 1, "c") for i, t in rows], SCHEMA)


def test_every_template_is_found_where_it_stands():
    scanner = op2.Scanner()
    for k, (name, text) in enumerate(op2.TEMPLATES):
        whole = PROSE + "\n" + text.upper() + ".\n" + PROSE
        found = scanner.find(whole)
        assert len(found) == 1 and found[0][2] == name and found[0][8] and found[0][6] == 0, (name, found)
        start, length = found[0][:2]
        first, last = op2.words(text)[0][0], op2.words(text)[-1][0]
        assert whole[start:start + length].lower().startswith(first) and whole[start:start + length].lower().endswith(last)


def test_given_notices_and_changes():
    scanner = op2.Scanner()
    one = lambda text: [(f[2], f[6], f[7], f[8]) for f in scanner.find(text)]
    assert one("Intro. Licensed under CC BY-NC 4.0. End") == [("CC-BY-NC-4.0", 0, "", True)]
    assert one("Licensed   under\nthe Apache%% License### Version 2.0") == [("Apache-2.0", 0, "", True)]
    changed = "This work is licenced under the GNU General Public License, version 3"
    assert one(changed) == [("GPL-3.0", 1, "licensed>licenced", True)]
    told = one("This work is licensed under the GNU General Public License, version 4")
    assert len(told) == 1 and not told[0][3]  # another version is no wording of it
    assert one("Her licence to drive was lost") == [] and one("") == []
    both = one(PROSE + "Released under the MIT License. " + PROSE + " Licensed under the Apache License, Version 2.0. " + PROSE)
    assert both == [("MIT", 0, "", True), ("Apache-2.0", 0, "", True)]


def reworded(text):
    """Every fifth word is another: too many to confirm, and the stretch still saves most with this template."""
    return " ".join("somehow" if i % 5 == 4 else w for i, w in enumerate(text.split()))


def test_short_notices_beside_reworded_long_ones():
    """Whatever saves more bytes in the same stretch, a notice that stands there word for word is confirmed."""
    scanner = op2.Scanner()
    long = [(k, t) for k, (_, t) in enumerate(op2.TEMPLATES) if len(t) > 110]
    for name, text in (t for t in op2.TEMPLATES if len(t[1]) < 80):
        for a, one in long:
            for _, two in long[:a]:
                whole = PROSE + reworded(one) + ". " + reworded(two) + ". " + PROSE[:60] + " " + text + ". " + PROSE
                found = [(f[2], f[6]) for f in scanner.find(whole) if f[8]]
                assert found == [(name, 0)], (name, one, two, found)


def test_a_stretch_tells_all_its_notices():
    scanner = op2.Scanner()
    told = lambda text: [(f[2], f[6], f[8]) for f in scanner.find(text)]
    bsd, isc = (reworded(next(t for n, t in op2.TEMPLATES if n == name)) for name in ("BSD-3-Clause", "ISC"))
    assert [(n, c) for n, _, c in told(f"{PROSE}{bsd}. {PROSE}{isc}. {PROSE}")] == [("BSD-3-Clause", False), ("ISC", False)]
    gpl = "This work is {} under the GNU General Public License, version {}. "  # one word differs in both: a version is no wording
    assert ("GPL-3.0", 1, True) in told(PROSE + gpl.format("licensed", 4) + PROSE + gpl.format("licenced", 3) + PROSE)
    many = told("Released under the MIT License. " * 300 + gpl.format("licensed", 2) * 20)
    assert many == [("MIT", 0, True)] * 300 + [("GPL-2.0", 0, True)] * 20


def test_very_long_text_of_licence_words():
    scanner = op2.Scanner()
    text = "license " * 9000 + "Released under the MIT License. " + "license " * 9000
    assert [f[2] for f in scanner.find(text) if f[8]] == ["MIT"]


def test_alignment_is_the_fewest_differences():
    assert op2.alignment(list("abcd"), list("xxabcdyy")) == (0, 2, 6, [])
    assert op2.alignment(list("abcd"), list("xabzcdy"))[:3] == (1, 1, 6)
    assert op2.alignment(list("abcd"), list("abd")) == (1, 0, 3, ["-c"])
    assert op2.alignment(list("abc"), [])[0] == 3


def test_query(spark):
    rows = [(1, PROSE + "Released under the MIT License."), (2, None), (3, ""), (4, PROSE), (None, "Licensed under CC BY-NC 4.0."),
            (5, "Licensed under CC BY-NC 4.0."), (5, "Licensed under CC BY-NC 4.0.")]
    got = op2.scan_licenses(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.license, r.confirmed) for r in got), key=repr) == sorted(
        [(1, "MIT", True), (None, "CC-BY-NC-4.0", True), (5, "CC-BY-NC-4.0", True), (5, "CC-BY-NC-4.0", True)], key=repr)
    assert all(r.bytes_given < r.bytes_alone for r in got)
    assert op2.scan_licenses(frame(spark, [])).collect() == []


def test_given_documents(spark):
    """Every notice line of the test tables is found, and nothing else is confirmed."""
    import re
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = sorted(r.doc_id for r in op2.scan_licenses(docs).collect() if r.confirmed)
    planted = sorted(r.doc_id for r in docs.collect() for _ in re.findall(r"(?i)(?:licensed|released) under", r.text or ""))
    assert found == planted


def test_the_compressor_ranks_and_prunes(monkeypatch):
    """Templates are aligned in the order of the bytes they save, no further than one that confirms; without savings none is."""
    scanner, asked = op2.Scanner(), []
    aligned = scanner._aligned

    def spy(k, *rest):
        asked.append(k)
        return aligned(k, *rest)
    monkeypatch.setattr(scanner, "_aligned", spy)
    for k, (name, text) in enumerate(op2.TEMPLATES):
        asked.clear()
        said = [w for w, _, _ in op2.words(PROSE + text + ". " + PROSE)]
        alone, rank = scanner.ranked(said)
        sizes = {t: len(scanner.given[t].compress(" ".join(said).encode())) for t in range(len(op2.TEMPLATES))}
        assert alone == len(scanner.alone.compress(" ".join(said).encode()))
        assert [t for _, t in rank] == sorted((t for t in sizes if sizes[t] < alone), key=lambda t: (sizes[t], -len(scanner.words[t]), t))
        assert [f[2] for f in scanner.find(PROSE + text + ". " + PROSE)] == [name]
        best = sizes[k]  # this one confirms: what saves less, beyond noise, was never aligned in the whole stretch
        upto = [t for size, t in rank if size <= best + op2.NOISE]
        assert asked[:len(upto)] == upto[:len(asked)] and asked[0] == rank[0][1]
    # one word tells these two apart, which is within what may differ: the savings choose
    lesser = "This work is licensed under the GNU Lesser General Public License, version 3"
    assert [f[2] for f in scanner.find(PROSE + lesser)] == ["LGPL-3.0"]
    true = scanner._sizes
    monkeypatch.setattr(scanner, "_sizes", lambda said: (10**6, [10 * (10**4 - n) for n in true(said)[1]]))
    assert [f[2] for f in scanner.find(PROSE + lesser)] == ["GPL-3.0"]
    monkeypatch.setattr(scanner, "_sizes", lambda said: (100, [100] * len(op2.TEMPLATES)))
    assert scanner.find(PROSE + lesser) == []


def brute(scanner, text):
    """Every template against every stretch of the text as long as it, give or take what may differ: the names that stand there."""
    own, names = [w for w, _, _ in op2.words(text)], set()
    for k, template in enumerate(scanner.words):
        slack = int(op2.MAX_DIFFERENT * len(template))
        for i in range(len(own)):
            for n in range(len(template) - slack, len(template) + slack + 1):
                if i + n <= len(own):
                    cost, _, _, told = op2.alignment(template, own[i:i + n])
                    if cost <= slack and scanner._confirms(told):
                        names.add(scanner.names[k])
    return names


def test_against_every_template_at_every_place():
    """Whole notices, changed by a word or not, in prose: the licences found are among those that brute force finds, none is missed."""
    import random
    rng, scanner = random.Random(3), op2.Scanner([t for t in op2.TEMPLATES if len(t[1]) < 130])
    kinds = [t for t in op2.TEMPLATES if len(t[1]) < 130]
    for _ in range(25):
        chosen = [rng.choice(kinds) for _ in range(rng.randint(0, 2))]
        parts = [PROSE[:120]]
        for _, text in chosen:
            said = text.split()
            if len(said) >= 10 and rng.random() < 0.5:
                said[rng.randint(1, 3)] = "otherwise"
            parts += [" ".join(said) + ".", PROSE[:rng.randint(20, 150)]]
        whole = " ".join(parts)
        told, possible = {f[2] for f in scanner.find(whole) if f[8]}, brute(scanner, whole)
        assert told <= possible and {n for n, _ in chosen} & possible <= told, (whole, told, possible)
