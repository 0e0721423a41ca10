"""License detection by ordered signature rules.

Words are runs of ASCII digits, ASCII letters (lower-cased) and all other
non-ASCII characters. A rule is a regular expression over words joined by spaces;
its first word is its keyword. A document is scanned only where a cheap prefilter
finds a trace of a license, and a rule is tried only at places of its keyword. Where
detections overlap, one that lies inside another of higher priority (or equal
priority and greater length, or equal in both and earlier in the rule list) is
suppressed. Everything happens within the row: no shuffle, so a hot source or a
repeated document costs no more than its own rows.
"""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

#: What separates words. A-Z count as letters here and are lower-cased later on.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Base phrases with their labels.
PHRASES = {"the mit license": "mit", "apache license version 2": "apache-2",
           "cc by nc": "cc-by-nc"}

#: Names of licenses, as regular expressions over words. ``V(3)`` is a version.
NAMES = [
    ("mit", r"(mit|expat)( license)?"),
    ("mit", r"x11 license"),
    ("apache-1.1", r"apache( software)?( license)? V(1 1)"),
    ("apache-2", r"apache( software)?( license)? V(2)"),
    ("bsd-2-clause", r"(2 clause|two clause|simplified|freebsd) bsd( license)?"),
    ("bsd-2-clause", r"bsd (2 clause|two clause)( license)?"),
    ("bsd-3-clause", r"(3 clause|three clause|new|modified|revised) bsd( license)?"),
    ("bsd-3-clause", r"bsd (3 clause|three clause)( license)?"),
    ("bsd", r"bsd license"),
    ("gpl-2", r"gnu (general|genral) public license V(2)"),
    ("gpl-2", r"(gnu )?gpl ?V(2)"),
    ("gpl-3", r"gnu (general|genral) public license V(3)"),
    ("gpl-3", r"(gnu )?gpl ?V(3)"),
    ("lgpl-2.1", r"gnu (lesser|library) general public license V(2( 1)?)"),
    ("lgpl-2.1", r"(gnu )?lgpl ?V(2( 1)?)"),
    ("lgpl-3", r"gnu lesser general public license V(3)"),
    ("lgpl-3", r"(gnu )?lgpl ?V(3)"),
    ("agpl-3", r"gnu affero general public license( V(3))?"),
    ("agpl-3", r"(gnu )?agpl ?V(3)"),
    ("gfdl", r"gnu free documentation license( V(1( [123])?))?"),
    ("mpl-1.1", r"mozilla public license V(1( 1)?)"),
    ("mpl-2", r"(mozilla public license|mpl) V(2)"),
    ("epl-1", r"(eclipse public license|epl) V(1)"),
    ("epl-2", r"(eclipse public license|epl) V(2)"),
    ("cddl-1", r"(common development and distribution license|cddl)( V(1))?"),
    ("artistic-2", r"artistic license( V(2))?"),
    ("boost-1", r"boost software license( V(1))?"),
    ("zlib", r"zlib( libpng)? license"),
    ("isc", r"isc license"),
    ("ofl-1.1", r"(sil )?open font license( V(1 1))?"),
    ("unlicense", r"(the )?unlicense"),
    ("wtfpl", r"wtfpl"),
    ("cc0", r"cc0( 1 0)?( universal)?"),
    ("cc-by", r"(cc by|creative commons attribution)( license)?( [1234] [05])?"),
    ("cc-by-sa", r"(cc by sa|creative commons attribution share ?alike)( [1234] [05])?"),
    ("cc-by-nd", r"(cc by nd|creative commons attribution no ?derivatives)( [1234] [05])?"),
    ("cc-by-nc", r"(cc by nc|creative commons attribution non ?commercial)( [1234] [05])?"),
    ("cc-by-nc-sa", r"(cc by nc sa|creative commons attribution non ?commercial share ?alike)( [1234] [05])?"),
    ("cc-by-nc-nd", r"(cc by nc nd|creative commons attribution non ?commercial no ?derivatives)( [1234] [05])?"),
    ("public-domain", r"public domain"),
]

#: Wordings around a name: keyword, pattern, priority. Priority / 100 is the
#: confidence of a detection.
WORDINGS = [
    ("spdx", r"spdx license identifier NAME", 100),
    ("licensed", r"licensed under( the)?( terms of)?( the)? NAME", 95),
    ("released", r"released (under|into)( the)?( terms of)?( the)? NAME", 92),
    ("distributed", r"distributed under( the)?( terms of)?( the)? NAME", 92),
    ("available", r"available under( the)?( terms of)?( the)? NAME", 90),
    ("published", r"published under( the)?( terms of)?( the)? NAME", 90),
    ("governed", r"governed by( the)?( terms of)?( the)? NAME", 88),
    ("subject", r"subject to( the)?( terms of)?( the)? NAME", 85),
    ("license", r"license( is| type)?( the)? NAME", 80),
]

#: Names that stand for a license without a wording around them, by first word.
BARE = {"apache": 70, "gnu": 70, "mozilla": 70, "eclipse": 70, "creative": 70,
        "boost": 70, "cc": 60, "mit": 60, "bsd": 60, "gpl": 60, "lgpl": 60,
        "agpl": 60, "mpl": 55, "epl": 55, "cc0": 60, "zlib": 60, "isc": 60}

#: Of these, words that need "license" after them.
WEAK = ("mit", "bsd", "isc", "zlib")

#: Texts and usual notices of licenses, which need not name them: pattern (its first
#: word is the keyword), label, priority. Distinctive clauses only.
NOTICES = [
    # MIT and its kin grant all that their text does; ISC and 0BSD share a grant.
    (r"permission is hereby granted free of charge to any person obtaining a copy of this"
     r" (software|font software)( and associated documentation files)?", "mit", 90),
    (r"permission is hereby granted free of charge to any person obtaining a copy of the font"
     r" software", "ofl-1.1", 94),
    (r"permission is hereby granted free of charge to any person or organization obtaining a copy",
     "boost-1", 94),
    (r"permission to use copy modify and( or)? distribute this software( and its documentation)?"
     r" for any purpose", "isc", 88),
    (r"redistribution and use in source and binary forms( with or without modification)?", "bsd", 88),
    (r"redistributions (of source code|in binary form) must (retain|reproduce) the above copyright"
     r" notice", "bsd", 84),
    (r"neither the names? of .{1,90}? contributors may be used to endorse or promote",
     "bsd-3-clause", 92),
    (r"views and conclusions contained in the software and documentation are those of"
     r" the authors", "bsd-2-clause", 86),
    # "either version N of the License", "version N only" and notices without a version.
    *((rf"gnu {kind}public license( {short})?( as)? published by the free software foundation"
       rf"( inc)?( either)? version {number}( 0)?", label, 94)
      for kind, short, number, label in (
          ("(general|genral) ", "gpl", "2", "gpl-2"), ("(general|genral) ", "gpl", "3", "gpl-3"),
          ("lesser general ", "lgpl", "2( 1)?", "lgpl-2.1"),
          ("library general ", "lgpl", "2( 1)?", "lgpl-2.1"),
          ("lesser general ", "lgpl", "3", "lgpl-3"),
          ("affero general ", "agpl", "3", "agpl-3"))),
    (r"gnu (general|genral) public license", "gpl", 50),
    (r"gnu (lesser|library) general public license", "lgpl", 50),
    (r"mozilla public license", "mpl", 50),
    (r"eclipse public license", "epl", 50),
    (r"apache (software )?license", "apache", 50),
    # Titles and first lines of the licenses' own texts.
    (r"everyone is permitted to copy and distribute verbatim copies of this license document",
     "gnu-license-text", 80),
    (r"everyone is permitted to copy and distribute verbatim or modified copies of this license"
     r" document", "wtfpl", 92),
    (r"terms and conditions for use reproduction and distribution 1 definitions", "apache-2", 90),
    (r"unless required by applicable law or agreed to in writing software distributed under the"
     r" license is distributed on an as is basis", "apache-2", 88),
    (r"source code form is subject to the terms of the mozilla public license v ?2", "mpl-2", 95),
    (r"software is provided as is without any express or implied warranty in no event will"
     r" the authors", "zlib", 88),
    (r"free and unencumbered software released into the public domain", "unlicense", 95),
]
#: What disclaims a warranty says that there is a license, not which.
NOTICES += [
    (r"software is provided as is (without warranty of any kind|and the author disclaims all"
     r" warranties)", "warranty-disclaimer", 40),
    (r"software is provided by the (copyright holders?( and contributors)?|authors?"
     r"( and contributors)?|regents and contributors) as is", "warranty-disclaimer", 40),
    (r"implied warranty of merchantability", "warranty-disclaimer", 40),
]

#: Traces without which neither a phrase nor a rule fits. The strings are looked for
#: first (all of a row must occur), the expression decides.
TRACES = [["licen"], ["spdx"], ["apache"], ["gnu"], ["gpl"], ["mozilla"], ["mpl"],
          ["epl"], ["eclipse"], ["creative"], ["bsd"], ["cc0"], ["cddl"], ["wtfpl"],
          ["expat"], ["public", "domain"], ["cc", "by"], ["under", "mit"],
          ["governed", "mit"], ["subject", "mit"], ["permission", "granted"],
          ["permission", "copy"], ["redistribution"], ["endorse", "promote"],
          ["views", "conclusions"], ["everyone", "permitted"], ["warrant"],
          ["provided", "as", "is"]]
TRACE = (r"(?i)licen[cs]e|spdx|apache|gnu|gpl|mozilla|mpl|epl|eclipse|creative|bsd|cc0"
         rf"|cddl|wtfpl|expat|public{GAP}domain|cc{GAP}by"
         rf"|permission{GAP}(is|to){GAP}(hereby|use)|redistributions?{GAP}(and|of|in){GAP}"
         rf"|neither{GAP}the{GAP}names?|views{GAP}and{GAP}conclusions|everyone{GAP}is{GAP}permitted"
         rf"|provided{GAP}(as|by)|implied{GAP}warranty"
         rf"|(under|into|by|to|of|the){GAP}mit")

#: No rule covers more words than this.
REACH = 40


def signature_rules() -> list[tuple[str, str, str, int]]:
    """``(keyword, pattern, label, priority)`` in order of precedence: every name in
    every wording, then the bare names, then texts and notices. Longer names come first."""
    def spelled(name: str) -> str:
        head, mark, rest = name.replace(" ?V(", " V(").partition(" V(")
        if not mark:
            return name
        depth, at = 1, 0
        while depth:
            depth += {"(": 1, ")": -1}.get(rest[at], 0)
            at += 1
        return (f"{head} ?(version |v ?)?({rest[:at - 1]})( 0)?( or later)?"
                + spelled(rest[at:]))

    names = [(label, spelled(name)) for label, name in NAMES]
    rules = [(keyword, f"^{wording.replace('NAME', f'({name})')} ", label, priority)
             for keyword, wording, priority in WORDINGS for label, name in names]
    # "license mit" would otherwise take any MIT in German prose.
    rules = [r for r in rules if not (r[0] == "license" and r[2] == "mit")]
    rules.append(("license", "^license( is| type)? mit( license)? ", "mit", 80))
    for first, priority in BARE.items():
        for label, name in names:
            if re.match(rf"[(]*({first}\b|[a-z ]+[)][?]?{first}\b|[a-z]+[|]{first}\b)", name):
                needs = "(?<=license )" if first in WEAK else ""
                rules.append((first, f"^(?={first} )({name}) {needs}", label, priority))
    for pattern, label, priority in NOTICES:
        rules.append((pattern.partition(" ")[0], f"^{pattern} ", label, priority))
    return rules


def _by_keyword(rules) -> Column:
    """A map literal: keyword to its rules."""
    groups: dict[str, list[dict]] = {}
    for order, (keyword, pattern, label, priority) in enumerate(rules):
        groups.setdefault(keyword, []).append(
            {"pattern": pattern, "label": label, "priority": priority, "place": order})
    return F.from_json(F.lit(json.dumps(groups)),
                       "map<string,array<struct<pattern:string,label:string,"
                       "priority:int,place:int>>>")


def _phrase_at(words: Column, phrase: str) -> Column:
    """Starts (from 0) of a phrase among raw words."""
    parts = phrase.split(" ")
    first = F.transform(words, lambda w, i: F.when(F.lower(w) == parts[0], i))
    return F.filter(first, lambda i: reduce(
        lambda a, b: a & b,
        [i.isNotNull()] + [ascii_lower(F.get(words, i + k)) == part
                           for k, part in enumerate(parts)]))


def scan(docs: DataFrame, text: str = "text", out: str = "license") -> DataFrame:
    """``docs`` with a struct column ``out``:

    ``n_words``; ``base`` (array of ``start``, ``label`` of base phrases);
    ``found`` (array of detections that stay: ``start``, ``stop`` in words,
    ``priority``, ``label``); ``labels`` (distinct, sorted); ``score`` from 0 to 1,
    the greatest confidence, 1 for a base phrase.

    Null and empty texts have no words, no labels and score 0. Every other column
    stays as it is (names that begin with ``__lw_`` are reserved); a column named like
    ``out`` is replaced. Repeated rows are
    scanned each on its own.
    """
    rules = signature_rules()
    keywords = sorted({r[0] for r in rules})
    by_keyword = _by_keyword(rules)
    raw = F.coalesce(F.col(text), F.lit(""))
    pieces = F.split(raw, GAP)
    n_words = F.greatest(F.lit(0), F.size(pieces)
                         - F.when(F.get(pieces, F.lit(0)) == "", 1).otherwise(0)
                         - F.when(F.element_at(pieces, -1) == "", 1).otherwise(0))
    low = F.lower(raw)
    trace = reduce(lambda a, b: a | b, [
        reduce(lambda a, b: a & b, [low.contains(x) for x in group])
        for group in TRACES]) & raw.rlike(TRACE)
    none = "array<struct<start:int,label:string>>"
    hit = "array<struct<start:int,stop:int,priority:int,label:string,place:int>>"

    counted = docs.select("*", F.struct(
        n_words.cast("long").alias("n"), trace.alias("trace")).alias("__lw_scan"))
    first = counted.withColumn("__lw_words", F.when(
        F.col("__lw_scan.trace"), F.filter(pieces, lambda x: x != "")))
    w, trace = F.col("__lw_words"), F.col("__lw_scan.trace")

    def labelled(phrase: str, label: str) -> Column:
        return F.transform(_phrase_at(w, phrase), lambda i: F.struct(
            i.cast("int").alias("start"), F.lit(label).alias("label")))

    base = F.concat(*[labelled(p, label) for p, label in PHRASES.items()])
    places = F.filter(F.transform(w, lambda x, i: F.struct(
        i.cast("int").alias("at"), F.lower(x).alias("word"))),
        lambda s: s["word"].isin(keywords))

    def tried(place):
        here = ascii_lower(F.concat(
            F.array_join(F.slice(w, place["at"] + 1, REACH), " "), F.lit(" ")))
        matched = F.transform(by_keyword[place["word"]], lambda r: F.struct(
            F.regexp_substr(here, r["pattern"]).alias("m"), r.alias("r")))
        return F.transform(F.filter(matched, lambda x: x["m"].isNotNull()), lambda x: F.struct(
            place["at"].alias("start"),
            (place["at"] + F.size(F.split(x["m"], " ")) - 1).cast("int").alias("stop"),
            x["r"]["priority"].alias("priority"), x["r"]["label"].alias("label"),
            x["r"]["place"].alias("place")))

    second = first.select(
        *[first[c] for c in docs.columns if c != out],
        F.col("__lw_scan.n").alias("__lw_n"),
        F.when(trace, base).otherwise(F.array().cast(none)).alias("__lw_base"),
        F.when(trace, F.transform(places, tried)).otherwise(
            F.array().cast(f"array<{hit}>")).alias("__lw_tried"))

    def inside(d, o):
        longer = (o["stop"] - o["start"]) - (d["stop"] - d["start"])
        return (o["start"] <= d["start"]) & (o["stop"] >= d["stop"]) & (
            (o["priority"] > d["priority"])
            | ((o["priority"] == d["priority"])
               & ((longer > 0) | ((longer == 0) & (o["place"] < d["place"])))))

    def stays(group, i):
        # Keyword places are at least a word apart: what covers place i lies among
        # the REACH places before it.
        since = F.greatest(i - REACH + 2, F.lit(1))
        near = F.flatten(F.slice(F.col("__lw_tried"), since, i + 1 - since + 1))
        return F.filter(group, lambda d: ~F.exists(near, lambda o: inside(d, o)))

    third = second.withColumn("__lw_found", F.flatten(F.transform(F.col("__lw_tried"), stays)))
    labels = F.array_sort(F.array_distinct(F.concat(
        F.transform("__lw_base", lambda b: b["label"]),
        F.transform("__lw_found", lambda d: d["label"]))))
    score = F.when(F.size("__lw_base") > 0, F.lit(1.0)).otherwise(F.coalesce(
        F.array_max(F.transform("__lw_found", lambda d: d["priority"])) / 100.0, F.lit(0.0)))
    return third.select(
        *[third[c] for c in docs.columns if c != out],
        F.struct(F.col("__lw_n").alias("n_words"), F.col("__lw_base").alias("base"),
                 F.transform("__lw_found", lambda d: d.dropFields("place")).alias("found"),
                 labels.alias("labels"), score.alias("score")).alias(out))


def license_report(docs: DataFrame) -> DataFrame:
    """The contract's row for each document."""
    found = scan(docs.select("doc_id", "text"))
    base = F.col("license.base")
    starts = F.transform(base, lambda b: b["start"])
    return found.select(
        "doc_id", F.col("license.n_words").alias("n_words"),
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(
            F.transform(base, lambda b: b["label"]))), ",").alias("base_labels"),
        F.array_join("license.labels", ",").alias("labels"),
        F.col("license.score").cast("double").alias("score"))
