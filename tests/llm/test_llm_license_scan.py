import re

from pyspark.sql import functions as F

from ledgerwatch.llm import license_scan as ls
from llm_fixtures import empty_documents, odd_documents, table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return WORD.findall(low)


def brute(text):
    """Words, base places and detections that stay, without any prefilter."""
    words = words_of(text)
    base = [(i, label) for phrase, label in ls.PHRASES.items() for i in range(len(words))
            if words[i:i + len(phrase.split())] == phrase.split()]
    found = []
    for i, word in enumerate(words):
        here = " ".join(words[i:i + ls.REACH]) + " "
        for place, (keyword, pattern, label, priority) in enumerate(ls.signature_rules()):
            if keyword == word and (m := re.search(pattern, here)):
                found.append((i, i + m[0].count(" "), priority, label, place))
    stays = [d for d in found if not any(
        o[0] <= d[0] and o[1] >= d[1] and (
            o[2] > d[2] or o[2] == d[2] and (o[1] - o[0] > d[1] - d[0] or (
                o[1] - o[0] == d[1] - d[0] and o[4] < d[4]))) for o in found)]
    labels = sorted({x for _, x in base} | {d[3] for d in stays})
    score = 1.0 if base else max([d[2] / 100 for d in stays], default=0.0)
    starts = [i for i, _ in base]
    return (len(words), len(base), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in base})), ",".join(labels), score)


TEXTS = [
    "Licensed under the Apache License, Version 2.0 and CC BY-NC 4.0", "The MIT License",
    "the mit license the MIT-LICENSE THE MIT LICENSE", "SPDX-License-Identifier: GPL-3.0-or-later",
    "released under GPLv3, lgpl v2.1; under the Mozilla Public License 2.0",
    "mit der Zeit mit uns", "this is published under MIT", "subject to the terms of the BSD license",
    "license: mit license is the ISC license", "creative commons attribution 4.0 CC-BY-NC-SA 4.0",
    "Apache License Version 2", "apache license version 2 apache license version 2",
    "GNU General Public License, version 3. gnu affero general public license",
    "x" * 100_000 + " the mit license " + "y " * 5_000, "distributed under the Unlicense",
    "MİT lıcense K the mit license", "", None, "\x00\x01", "the\x00mit\x7flicense",
    "dual licensed under the MIT or apache 2", "into the public domain released into public domain"]


def test_matches_brute_force(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for row in ls.license_report(docs).collect():
        assert tuple(row)[1:] == brute(TEXTS[row.doc_id]), TEXTS[row.doc_id]


def test_table(spark):
    docs = table(spark, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for row in ls.license_report(docs).collect():
        assert tuple(row)[1:] == brute(texts[row.doc_id])


NOTICES = {
    "gpl-3": """This program is free software: you can redistribute it and/or modify it under the
        terms of the GNU General Public License as published by the Free Software Foundation, either
        version 3 of the License, or (at your option) any later version.""",
    "lgpl-2.1": """under the terms of the GNU Lesser General Public License as published by the
        Free Software Foundation; either version 2.1 of the License, or any later version""",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy of this
        software and associated documentation files (the "Software"), to deal in the Software""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with
        or without fee is hereby granted""",
    "bsd-3-clause": """Neither the name of the copyright holder nor the names of its contributors may
        be used to endorse or promote products derived from this software""",
    "bsd": """ * Redistribution and use in source and binary forms, with or without
        * modification, are permitted provided that the following conditions are met:""",
    "boost-1": """Permission is hereby granted, free of charge, to any person or organization
        obtaining a copy of the software and accompanying documentation""",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "warranty-disclaimer": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND',
    "gpl": "See the GNU General Public License for more details.",
}


def test_license_texts_and_notices(spark):
    docs = spark.createDataFrame(list(NOTICES.items()), "doc_id string, text string")
    for row in ls.license_report(docs).collect():
        assert row.doc_id in row.labels.split(","), (row.doc_id, row.labels)
        assert row.score > 0 and tuple(row)[1:] == brute(NOTICES[row.doc_id])


def test_rules():
    rules = ls.signature_rules()
    assert len(rules) > 300 and len({(r[1], r[2]) for r in rules}) == len(rules)
    assert all(re.search(rf"\^(\(\?=)?\(*{r[0]}|\(\?={r[0]} ", r[1]) for r in rules)


def test_odd_rows(spark):
    out = ls.scan(odd_documents(spark).withColumn("license", F.lit("old")))
    assert out.count() == 15 and out.columns.count("license") == 1
    assert ls.license_report(empty_documents(spark)).count() == 0
