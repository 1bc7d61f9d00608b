import random
import textwrap

import pytest

from seepline.llm import licences


@pytest.fixture(scope="module")
def model(prose):
    return licences.fit([licences.words_of(prose(i, 20)) for i in range(600)])


def test_families(model, prose):
    rng = random.Random(5)
    right = total = 0
    for family, notices in licences.NOTICES.items():
        for notice in notices:
            for _ in range(3):
                words = licences.words_of(notice)
                if len(words) > 6:
                    words.pop(rng.randrange(len(words)))
                words = licences.words_of(prose(rng.randint(1000, 2000), 5)) + words
                right += model.classify([words])[0][0] == family
                total += 1
    assert right >= 0.9 * total


def test_unknown(model, prose):
    lines = [licences.words_of(prose(i, 25)) for i in range(5000, 5200)]
    lines += [licences.words_of(t) for t in ("the licensed public house", "software is free", "general public", "")]
    assert all(c[0] == "unknown" for c in model.classify(lines))


def test_scan(frame, prose, model):
    given = [(1, f"{prose(1, 30)}\nLicensed under CC BY-NC 4.0."), (2, prose(2, 30)), (3, None), (4, ""), (None, "Released under the MIT License."), (5, "MIT " * 20_000), (1, "Released under the MIT License.")]
    got = {(r["doc_id"], r["line"], r["family"]) for r in licences.scan(frame(given), model).collect()}
    assert got == {(1, 1, "CC-BY-NC"), (None, 0, "MIT"), (1, 0, "MIT")}
    assert licences.scan(frame(given).limit(0), licences.train(frame(given).limit(0))).count() == 0


MIT = """MIT License

Copyright (c) 2020 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."""
BSD = "Copyright (c) 2020, Some One. All rights reserved.\n\nRedistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
GPL = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."


@pytest.mark.parametrize("width", [30, 50, 72, 78])
@pytest.mark.parametrize("mark", ["", " * ", "# ", "// "])
def test_wrapped(frame, prose, model, width, mark):
    """Notices wrapped at any width and behind comment marks are found, where they stand."""
    given = []
    for k, text in enumerate((MIT, BSD, GPL)):
        lines = [mark + w for p in text.split("\n") for w in (textwrap.wrap(p, width) or [""])]
        given.append((k, "\n".join([prose(k, 12), mark.rstrip(), *lines, "", prose(k + 9, 30)])))
    given.append((3, "\n".join(textwrap.wrap(prose(40, 300) + " the licensed public software", width))))
    rows = licences.scan(frame(given), model).collect()
    assert {(r["doc_id"], r["family"]) for r in rows} == {(0, "MIT"), (1, "BSD"), (2, "GPL")}
    for r in rows:
        lines = given[r["doc_id"]][1].split("\n")
        assert r["start"] == sum(len(x) + 1 for x in lines[: r["line"]])
        assert given[r["doc_id"]][1][r["start"] : r["end"] + 1].endswith("\n")
    assert sum(r["doc_id"] == 0 for r in rows) >= 2


def test_long_lines_are_trained_on_whole(frame, prose, monkeypatch):
    """Every part of a line may be drawn, and repeated rows may repeat."""
    seen = []
    monkeypatch.setattr(licences, "fit", lambda lines: seen.extend(lines))
    text = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(3000))
    licences.train(frame([(1, text), (2, "short line"), (2, "short line"), (3, None)]), max_lines=100, piece=500)
    words = {w for line in seen for w in line}
    assert {"wordaaa", licences.words_of(text)[-1], licences.words_of(text)[1500]} <= words
    assert max(len(" ".join(line)) for line in seen) <= 510
