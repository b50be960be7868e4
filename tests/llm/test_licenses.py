import random

from hypothesis import given, settings
from hypothesis import strategies as st

from tributary.llm.licenses import TEMPLATES, Scanner, increasing, patience, scan_licenses, tokens


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=9))
def test_increasing_is_longest(values):
    best = 0
    for mask in range(1 << len(values)):
        picked = [v for i, v in enumerate(values) if mask >> i & 1]
        if all(a < b for a, b in zip(picked, picked[1:])):
            best = max(best, len(picked))
    got = [values[i] for i in increasing(values)]
    assert len(got) == best and all(a < b for a, b in zip(got, got[1:]))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcdef"), max_size=12), st.lists(st.sampled_from("abcdef"), max_size=12))
def test_alignment_is_a_common_subsequence(text, template):
    pairs = patience(text, template)
    assert all(text[i] == template[j] for i, j in pairs)
    assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(pairs, pairs[1:]))
    table = [[0] * (len(template) + 1) for _ in range(len(text) + 1)]
    for i, w in enumerate(text):
        for j, v in enumerate(template):
            table[i + 1][j + 1] = table[i][j] + 1 if w == v else max(table[i][j + 1], table[i + 1][j])
    assert len(pairs) <= table[-1][-1]
    if text == template:
        assert len(pairs) == len(text)


def test_every_template_is_found_whole_and_edited():
    rng, scanner = random.Random(1), Scanner()
    noise = lambda n: " ".join("".join(rng.choices("bcdfgaeiou", k=6)) for _ in range(n))
    for name, texts in TEMPLATES.items():
        for text in texts:
            around = f"{noise(30)}. {text} {noise(30)} {text}"
            found = scanner.scan(around)
            assert [(f[0], f[1]) for f in found if f[4] == len(tokens(text))][:1] == [(found[0][0], 1.0)] and len(found) >= 2, (name, text)
            words = text.split()
            if len(words) > 40:
                for at in rng.sample(range(len(words)), len(words) // 12):
                    words[at] = noise(1)
                edited = scanner.scan(f"{noise(5)} {' '.join(words)}")
                assert edited and edited[0][1] >= 0.8, name
    assert scanner.scan(noise(500)) == []


def test_longer_template_wins_and_places_are_right():
    text = "Intro. " + TEMPLATES["Apache-2.0"][0]
    found = Scanner().scan(text)
    assert [f[0] for f in found] == ["Apache-2.0"] and text[found[0][2] :].startswith("Licensed under") and found[0][4] == len(tokens(TEMPLATES["Apache-2.0"][0]))


def test_rows(spark):
    rows = spark.createDataFrame([(1, "Released under the MIT License.", "x"), (2, None, "x"), (3, "", None), (1, "Released under the MIT License.", "x"), (4, "Licensed under CC BY-NC 4.0.\n" * 3, "y")], "doc_id long, text string, license string")
    got = sorted((r.doc_id, r.license, r.first) for r in scan_licenses(rows).collect())
    assert got[:2] == [(1, "MIT", 0)] * 2 and [g[:2] for g in got[2:]] == [(4, "CC-BY-NC-4.0")] * 3
    assert scan_licenses(rows.limit(0)).count() == 0


def names(text):
    return [f[0] for f in Scanner().scan(text)]


def test_a_notice_that_misses_its_rarest_words_is_found_whatever_stands_around_it():
    """With every share of its words missing that the coverage allows."""
    scanner = Scanner()
    for (name, words), needed in zip(scanner.templates, scanner.needed):
        assert needed == -(-4 * len(words) // 5)
        for gone in (sorted(set(words)), sorted(set(words), key=lambda w: w not in scanner.keys)):
            left, n = list(words), len(words) - needed
            for w in gone:
                if left.count(w) <= n - (len(words) - len(left)):
                    left = [x for x in left if x != w]
            assert not scanner.keys.isdisjoint(left), (name, words)


def test_notices_need_the_names_of_their_licence():
    assert names("Licensed under the MIT License.") == ["MIT"] == names("Licensed under the M.I.T. License.")
    assert names("Licensed under the Apache License.") == [] == names("Licensed under the ISC License.")
    assert names("Licensed under the Apache License, Version 1.1") == []
    assert names("Licensed under the Apache License, Version 2") == ["Apache-2.0"]
    assert names("Licensed under CC BY-ND 4.0.") == [] and names("Licensed under CC BY-SA 4.0.") == ["CC-BY-SA-4.0"]
    assert names("This work is licensed under the GNU Lesser General Public License, version 3.") == ["LGPL-3.0"]
    assert names("This library is licensed under the GNU General Public License, version 3.") == ["GPL-3.0"]
    assert names("This work is licensed under a Creative Commons Attribution 3.0 International License.") == []


def test_longer_notices_of_other_versions():
    gpl = TEMPLATES["GPL-3.0"][0]
    assert names(gpl) == ["GPL-3.0"] and names(gpl.replace("version 3", "version 2")) == ["GPL-2.0"]
    assert names(gpl.replace("GNU General", "GNU Lesser General")) == ["LGPL-3.0"] and names(gpl.replace("version 3", "version 9")) == []
    assert names(TEMPLATES["Apache-2.0"][0].replace("Version 2.0", "Version 1.1")) == []


def test_headings_and_short_notices():
    assert names("BSD 3-Clause License\n\nSome text") == ["BSD-3-Clause"] and names("under a 2-clause BSD license, as is") == ["BSD-2-Clause"]
    assert names("Distributed under the terms of the GNU GPL v3.") == ["GPL-3.0"] == names("Distributed under the terms of the GNU GPL 3.0.")
    assert names("Distributed under the terms of the GNU GPL v2.") == ["GPL-2.0"] and names("Distributed under the terms of the GNU GPL v4.") == []
    assert names("Licensed under the GNU Affero General Public License v3.0.") == ["AGPL-3.0"] and names("Distributed under the MIT License.") == ["MIT"]
    assert names("Released under the Mozilla Public License, version 2.0.") == ["MPL-2.0"] and names("Released under the Mozilla Public License, version 1.1.") == []
    assert names("Licensed under the BSD 4-Clause License.") == [] == names("The BSD systems have a clause on their license.")


def test_every_passage_that_a_window_of_every_place_finds():
    """Against aligning every template at every place: what reaches the coverage in a window of the template's size, names included, is found."""
    rng, scanner = random.Random(9), Scanner()
    short = [(n, t) for n, texts in TEMPLATES.items() for t in texts if len(tokens(t)) <= 14]
    noise = lambda n: ["".join(rng.choices("bcdfgaeiou", k=6)) for _ in range(n)]
    for _ in range(60):
        words = noise(rng.randrange(12))
        for _, t in rng.sample(short, rng.choice([0, 1, 2])):
            own = tokens(t)
            if rng.random() < 0.5:
                own[rng.randrange(len(own))] = noise(1)[0]
            words += [*own, *noise(rng.randrange(20))]
        text = " ".join(words)
        found, words = scanner.scan(text), tokens(text)
        spans = [(len(text[:a].split()), len(text[:b].split())) for _, _, a, b, _ in found]
        for k, (name, template) in enumerate(scanner.templates):
            for at in range(max(1, len(words) - len(template) + 1)):
                matched = patience(words[at : at + len(template)], template)
                if len(matched) >= scanner.needed[k] and scanner._named(k, words[at : at + len(template)], matched):
                    assert any(a <= at + matched[-1][0] and at + matched[0][0] < b for a, b in spans), (name, text)


SCANNER = Scanner()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(sorted(SCANNER.keys)), st.sampled_from([" ", "-", "_", ".", "'", "İ", "ß", "é", "7", "x", "\n"]), st.text(max_size=3)), max_size=12))
def test_a_text_with_a_key_is_never_passed_over(parts):
    text = "".join(parts)
    if not SCANNER.keys.isdisjoint(tokens(text)):
        assert SCANNER._may_match(text.lower())
