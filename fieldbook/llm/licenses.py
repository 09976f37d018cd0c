"""License detection by ordered signature rules, in DataFrame expressions only.

Text becomes a stream of lower-case words.  A rule is a regular expression over that
stream, gated by a keyword: only rules whose keyword stands in a text are tried on it.
Rules are ordered, best first.  A detection whose interval lies in another one's is
suppressed (of equal intervals the better rule stays); of two that overlap in part the one
of the worse rule yields.

Defined results: null text has no words and no detection; repeated rows and rows without
an id are judged one by one.
"""

from __future__ import annotations

import itertools
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Everything that is no word: ASCII but digits and letters.
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Phrases whose words must stand one after another, and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Of docs.python.org only the page of its license: a language and a version may stand between.
_PYTHON_ADDRESS = (
    "docs python org(?: (?:de|en|es|fr|hu|id|it|ja|ko|pl|pt br|ro|ru|tr|uk|zh cn|zh tw))?"
    "(?: (?:[0-9]+|dev|release|py3k)){0,4} license"
)

# Families, best known first: label, keyword, name, SPDX name, address.  In patterns a
# space is any gap between two words; the SPDX name and address are written as words.
_FAMILIES = [
    ("agpl-3.0", "agpl|affero", "(?:gnu )?(?:affero general public licen[cs]e|agpl)(?: version| v)? ?3(?: 0)?", "agpl 3 0(?: only| or later)?", "gnu org licenses agpl 3 0"),
    ("agpl", "agpl|affero", "(?:gnu )?(?:affero general public licen[cs]e|agpl)", "agpl [0-9]+ [0-9]+", "gnu org licenses agpl"),
    ("lgpl-3.0", "lgpl|lesser", "(?:gnu )?(?:lesser general public licen[cs]e|lgpl)(?: version| v)? ?3(?: 0)?", "lgpl 3 0(?: only| or later)?", "gnu org licenses lgpl 3 0"),
    ("lgpl-2.1", "lgpl|lesser", "(?:gnu )?(?:lesser general public licen[cs]e|lgpl)(?: version| v)? ?2 1", "lgpl 2 1(?: only| or later)?", "gnu org licenses (?:old licenses )?lgpl 2 1"),
    ("lgpl-2.0", "lgpl|library", "(?:gnu )?(?:library general public licen[cs]e|lgpl)(?: version| v)? ?2(?: 0)?", "lgpl 2 0(?: only| or later)?", "gnu org licenses (?:old licenses )?lgpl 2 0"),
    ("lgpl", "lgpl|lesser", "(?:gnu )?(?:lesser general public licen[cs]e|lgpl)", "lgpl [0-9]+ [0-9]+", "gnu org licenses lgpl"),
    ("gpl-3.0", "gpl|general", "(?:gnu )?(?:general public licen[cs]e|gpl)(?: version| v)? ?3(?: 0)?", "gpl 3 0(?: only| or later)?", "gnu org licenses gpl 3 0"),
    ("gpl-2.0", "gpl|general", "(?:gnu )?(?:general public licen[cs]e|gpl)(?: version| v)? ?2(?: 0)?", "gpl 2 0(?: only| or later)?", "gnu org licenses (?:old licenses )?gpl 2 0"),
    ("gpl", "gpl|general", "(?:gnu )?(?:general public licen[cs]e|gpl)", "gpl [0-9]+ [0-9]+", "gnu org (?:licenses|copyleft) gpl"),
    ("gfdl", "gfdl|documentation", "(?:gnu )?(?:free documentation licen[cs]e|gfdl)(?: version| v)?(?: ?1 [123])?", "gfdl 1 [123](?: only| or later)?", "gnu org licenses fdl"),
    ("apache-2.0", "apache", "apache(?: software)?(?: licen[cs]e)?(?: version| v)? 2(?: 0)?", "apache 2 0", "apache org licenses license 2 0"),
    ("apache-1.1", "apache", "apache(?: software)?(?: licen[cs]e)?(?: version| v)? 1 1", "apache 1 1", "apache org licenses license 1 1"),
    ("apache", "apache", "apache(?: software)? licen[cs]e", "apache [0-9]+ [0-9]+", "apache org licenses"),
    ("cc0-1.0", "cc0|zero|publicdomain", "(?:creative commons(?: cc0)? zero|cc0)(?: universal)?(?: 1 0)?(?: universal)?", "cc0 1 0", "creativecommons org publicdomain zero 1 0"),
    ("cc-by-nc-nd-4.0", "cc|creative", "(?:cc|creative commons) (?:by|attribution) (?:nc|noncommercial|non commercial) (?:nd|noderivatives|noderivs|no derivatives) 4 0", "cc by nc nd 4 0", "creativecommons org licenses by nc nd 4 0"),
    ("cc-by-nc-sa-4.0", "cc|creative", "(?:cc|creative commons) (?:by|attribution) (?:nc|noncommercial|non commercial) (?:sa|sharealike|share alike) 4 0", "cc by nc sa 4 0", "creativecommons org licenses by nc sa 4 0"),
    ("cc-by-nc-4.0", "cc|creative", "(?:cc|creative commons) (?:by|attribution) (?:nc|noncommercial|non commercial) 4 0", "cc by nc 4 0", "creativecommons org licenses by nc 4 0"),
    ("cc-by-nd-4.0", "cc|creative", "(?:cc|creative commons) (?:by|attribution) (?:nd|noderivatives|noderivs|no derivatives) 4 0", "cc by nd 4 0", "creativecommons org licenses by nd 4 0"),
    ("cc-by-sa-4.0", "cc|creative", "(?:cc|creative commons) (?:by|attribution) (?:sa|sharealike|share alike) 4 0", "cc by sa 4 0", "creativecommons org licenses by sa 4 0"),
    ("cc-by-sa-3.0", "cc|creative", "(?:cc|creative commons) (?:by|attribution) (?:sa|sharealike|share alike) 3 0", "cc by sa 3 0", "creativecommons org licenses by sa 3 0"),
    ("cc-by-4.0", "cc|creative", "(?:cc|creative commons) (?:by|attribution) 4 0", "cc by 4 0", "creativecommons org licenses by 4 0"),
    ("cc-by-3.0", "cc|creative", "(?:cc|creative commons) (?:by|attribution) 3 0", "cc by 3 0", "creativecommons org licenses by 3 0"),
    ("cc-by-nc-nd", "cc|creative", "(?:cc|creative commons) (?:by|attribution) (?:nc|noncommercial|non commercial) (?:nd|noderivatives|noderivs|no derivatives)", "cc by nc nd [0-9]+ [0-9]+", "creativecommons org licenses by nc nd"),
    ("cc-by-nc-sa", "cc|creative", "(?:cc|creative commons) (?:by|attribution) (?:nc|noncommercial|non commercial) (?:sa|sharealike|share alike)", "cc by nc sa [0-9]+ [0-9]+", "creativecommons org licenses by nc sa"),
    ("cc-by-nc", "cc|creative", "(?:cc|creative commons) (?:by|attribution) (?:nc|noncommercial|non commercial)", "cc by nc [0-9]+ [0-9]+", "creativecommons org licenses by nc"),
    ("cc-by-nd", "cc|creative", "(?:cc|creative commons) (?:by|attribution) (?:nd|noderivatives|noderivs|no derivatives)", "cc by nd [0-9]+ [0-9]+", "creativecommons org licenses by nd"),
    ("cc-by-sa", "cc|creative", "(?:cc|creative commons) (?:by|attribution) (?:sa|sharealike|share alike)", "cc by sa [0-9]+ [0-9]+", "creativecommons org licenses by sa"),
    ("cc-by", "cc|creative", "(?:cc by|creative commons attribution)", "cc by [0-9]+ [0-9]+", "creativecommons org licenses by"),
    ("mit", "mit|expat|x11", "(?:mit|expat|x11|mit x11)(?: style)? licen[cs]e", "(?:mit|x11)", "opensource org licen[cs]es? mit"),
    ("bsd-4-clause", "bsd", "(?:original bsd|bsd 4 clause|4 clause bsd|four clause bsd)(?: licen[cs]e)?", "bsd 4 clause", "spdx org licenses bsd 4 clause"),
    ("bsd-3-clause", "bsd", "(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd)(?: licen[cs]e)?", "bsd 3 clause", "opensource org licen[cs]es? bsd 3 clause"),
    ("bsd-2-clause", "bsd", "(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd|two clause bsd)(?: licen[cs]e)?", "bsd 2 clause", "opensource org licen[cs]es? bsd 2 clause"),
    ("0bsd", "0bsd|bsd", "(?:0bsd|zero clause bsd|bsd zero clause)(?: licen[cs]e)?", "0bsd", "opensource org licen[cs]es? 0bsd"),
    ("bsd", "bsd", "bsd(?: style)? licen[cs]e", "bsd", "opensource org licen[cs]es? bsd"),
    ("isc", "isc", "isc licen[cs]e", "isc", "opensource org licen[cs]es? isc"),
    ("mpl-2.0", "mpl|mozilla", "(?:mozilla public licen[cs]e|mpl)(?: version| v)? 2(?: 0)?", "mpl 2 0", "mozilla org (?:en us )?mpl 2 0"),
    ("mpl-1.1", "mpl|mozilla", "(?:mozilla public licen[cs]e|mpl)(?: version| v)? 1 1", "mpl 1 1", "mozilla org (?:en us )?mpl 1 1"),
    ("mpl", "mpl|mozilla", "(?:mozilla public licen[cs]e|mpl)", "mpl [0-9]+ [0-9]+", "mozilla org (?:en us )?mpl"),
    ("epl-2.0", "epl|eclipse", "(?:eclipse public licen[cs]e|epl)(?: version| v)? 2(?: 0)?", "epl 2 0", "eclipse org (?:legal )?epl 2 0"),
    ("epl-1.0", "epl|eclipse", "(?:eclipse public licen[cs]e|epl)(?: version| v)? 1(?: 0)?", "epl 1 0", "eclipse org (?:legal )?epl v10"),
    ("cddl-1.0", "cddl|distribution", "(?:common development and distribution licen[cs]e|cddl)(?: version| v)?(?: 1 [01])?", "cddl 1 [01]", "opensource org licen[cs]es? cddl"),
    ("cpl-1.0", "cpl|common", "(?:common public licen[cs]e|cpl)(?: version| v)?(?: 1 0)?", "cpl 1 0", "opensource org licen[cs]es? cpl"),
    ("eupl-1.2", "eupl|european", "(?:european union public licen[cs]e|eupl)(?: version| v)?(?: 1 2)?", "eupl 1 2", "joinup ec europa eu (?:page|collection eupl) eupl"),
    ("artistic-2.0", "artistic|perl", "(?:the )?artistic licen[cs]e(?: version| v)?(?: 2 0)?", "artistic 2 0", "opensource org licen[cs]es? artistic"),
    ("bsl-1.0", "boost", "boost software licen[cs]e(?: version| v)?(?: 1 0)?", "bsl 1 0", "boost org license 1 0"),
    ("busl-1.1", "business|busl", "business source licen[cs]e(?: version| v)?(?: 1 1)?", "busl 1 1", "mariadb com bsl11"),
    ("zlib", "zlib|libpng", "(?:zlib|libpng|zlib libpng)(?: style)? licen[cs]e", "zlib", "zlib net zlib license"),
    ("unlicense", "unlicense", "(?:the )?unlicense", "unlicense", "unlicense org"),
    ("wtfpl", "wtfpl|fuck", "(?:wtfpl|do what the fuck you want to public licen[cs]e)", "wtfpl", "wtfpl net"),
    ("python-2.0", "python|psf", "(?:python software foundation|psf|python) licen[cs]e(?: version| v)?(?: 2)?", "(?:psf|python) 2 0", _PYTHON_ADDRESS),
    ("ofl-1.1", "ofl|sil", "(?:sil )?(?:open font licen[cs]e|ofl)(?: version| v)?(?: 1 1)?", "ofl 1 1", "scripts sil org ofl"),
    ("odbl-1.0", "odbl|database", "(?:open (?:data commons open )?database licen[cs]e|odbl)(?: 1 0)?", "odbl 1 0", "opendatacommons org licenses odbl"),
    ("ms-pl", "microsoft", "microsoft public licen[cs]e", "ms pl", "opensource org licen[cs]es? ms pl"),
    ("upl-1.0", "upl|universal", "(?:universal permissive licen[cs]e|upl)(?: version| v)?(?: 1 0)?", "upl 1 0", "oss oracle com licenses upl"),
    ("openrail", "openrail|rail", "(?:bigscience|creativeml)? ?open ?rail(?: [ms])? ?(?:licen[cs]e)?", "openrail", "huggingface co spaces [a-z]+ license"),
]

# Texts and notices by which a license is known without its name.
_NOTICES = [
    ("gpl", "redistribute", "this program is free software you can redistribute it and or modify it", 0.95),
    ("gpl", "warranty", "this program is distributed in the hope that it will be useful but without any warranty", 0.9),
    ("lgpl", "library", "this library is free software you can redistribute it and or modify it", 0.95),
    ("apache-2.0", "applicable", "unless required by applicable law or agreed to in writing software distributed under the licen[cs]e", 0.95),
    ("mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy", 0.95),
    ("mit", "merchantability", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability", 0.7),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted", 0.95),
    ("bsd-3-clause", "endorse", "neither the name of [^.]{1,80} may be used to endorse or promote products", 0.9),
    ("bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software must display", 0.95),
    ("isc", "modify", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted", 0.95),
    ("mpl-2.0", "mozilla", "this source code form is subject to the terms of the mozilla public licen[cs]e", 0.95),
    ("epl-2.0", "eclipse", "made available under the terms of the eclipse public licen[cs]e", 0.95),
    ("bsl-1.0", "machine", "machine executable object code generated by a source language processor", 0.9),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented", 0.95),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain", 0.95),
    ("wtfpl", "fuck", "you just do what the fuck you want to", 0.95),
    ("cc-by", "attribution", "this work is licensed under a creative commons attribution(?: (?:[0-9]+|international|unported|generic|intergovernmental|public))* licen[cs]e", 0.85),
    ("public-domain", "domain", "(?:released|dedicated|placed) (?:in|into|to) the public domain", 0.8),
    ("public-domain", "domain", "this work is in the public domain", 0.8),
    ("proprietary", "confidential", "proprietary and confidential", 0.8),
    ("proprietary", "unauthorized", "unauthorized (?:copying|reproduction|use|distribution) of this (?:file|software|work|document)", 0.8),
    ("all-rights-reserved", "reserved", "all rights reserved", 0.6),
    ("all-rights-reserved", "reservados", "todos los derechos reservados", 0.6),
    ("all-rights-reserved", "vorbehalten", "alle rechte vorbehalten", 0.6),
    ("all-rights-reserved", "réservés", "tous droits réservés", 0.6),
    ("copyright-notice", "copyright", "copyright (?:c )?(?:19|20)[0-9][0-9]", 0.4),
]

_GRANT = (
    "(?:licen[cs]ed|released|distributed|available|provided|published|covered|offered)"
    "(?: to you)? under (?:a |an |the )?(?:terms (?:and conditions )?of )?(?:a |an |the )?"
)

RULE = "array<struct<rule:int,label:string,gate:string,pattern:string,score:double>>"


def signature_rules() -> list[dict]:
    """The rules in their order; `gate` is the keyword that lets the rule be tried."""
    found: list[tuple[str, str, str, float]] = []
    for label, gates, name, spdx, address in _FAMILIES:
        first = address.split(" ")[0]
        found.append((label, "spdx", f"spdx licen[cs]e identifier {spdx}", 1.0))
        found.append((label, first, f"(?:www )?{address}", 0.95))
        for gate in gates.split("|"):
            found.append((label, gate, _GRANT + name, 0.9))
            found.append((label, gate, f"(?:this|the) (?:\\S+ ){{0,3}}is (?:subject to|governed by) (?:the )?(?:terms of )?(?:the )?{name}", 0.85))
            found.append((label, gate, name, 0.75))
    found += _NOTICES
    # Better evidence comes first; among equals the order above decides.
    ordered = sorted(dict.fromkeys(found), key=lambda rule: -rule[3])
    return [
        {
            "rule": k,
            "label": label,
            "gate": gate,
            # Words stand two spaces apart, so that neighbours share no space.
            "pattern": "(?<= )(?:" + pattern.replace(" ", "  ") + ")(?= )",
            "score": score,
        }
        for k, (label, gate, pattern, score) in enumerate(ordered)
    ]


def word_stream(text: Column) -> Column:
    """Lower-case words of `text` as '  one  two  three  '; two spaces without words."""
    padded = F.concat(F.lit(" "), F.coalesce(text, F.lit("")), F.lit(" "))
    return F.lower(F.regexp_replace(padded, _GAP, "  "))


def words_in(piece: Column) -> Column:
    """Number of words in the part of a word stream before or after a match."""
    spaces = F.length(piece) - F.length(F.replace(piece, F.lit(" "), F.lit("")))
    return F.floor(spaces / 2)


def phrase_places(stream: Column, n_words: Column, phrases: dict[str, str]) -> dict[str, Column]:
    """Columns n (all places), first and last (word numbers) and labels of `phrases`."""
    counts, firsts, lasts, labels = [], [], [], []
    for phrase, label in phrases.items():
        words = phrase.split(" ")
        spaced = " " + "  ".join(words) + " "
        needle = F.lit(spaced)
        there = F.contains(stream, needle)
        left = F.length(F.replace(stream, needle, F.lit("")))
        places = ((F.length(stream) - left) / F.length(needle)).cast("long")
        counts.append(F.when(there, places).otherwise(F.lit(0)))
        before = F.substring_index(stream, spaced, 1)
        after = F.substring_index(stream, spaced, -1)
        firsts.append(F.when(there, words_in(before)))
        lasts.append(F.when(there, n_words - words_in(after) - len(words)))
        labels.append(F.when(there, F.lit(label)))
    return {
        "n": sum(counts[1:], counts[0]).cast("long"),
        "first": F.array_min(F.array(*firsts)),
        "last": F.array_max(F.array(*lasts)),
        "labels": F.array_sort(F.array_distinct(F.array_compact(F.array(*labels)))),
    }


def gated_matches(stream: Column, rules: list[dict]) -> Column:
    """Per rule whose keyword stands in `stream` and that matches: gaps and matches."""
    table = F.from_json(F.lit(json.dumps(rules)), RULE)
    gates = sorted({rule["gate"] for rule in rules})
    by_letter = [
        letter + "(?:" + "|".join(gate[1:] for gate in same) + ")"
        for letter, same in itertools.groupby(gates, key=lambda gate: gate[0])
    ]
    any_gate = " (?:" + "|".join(by_letter) + ") "
    words = F.array_intersect(F.split(stream, " +"), F.array(*map(F.lit, gates)))
    tried = F.transform(
        F.array(words),
        lambda seen: F.filter(table, lambda r: F.array_contains(seen, r["gate"])),
    )[0]
    matched = F.transform(
        tried,
        lambda r: F.struct(
            r["rule"].alias("rule"),
            r["label"].alias("label"),
            r["score"].alias("score"),
            F.split(stream, r["pattern"]).alias("gaps"),
            F.regexp_extract_all(stream, r["pattern"], F.lit(0)).alias("matches"),
        ),
    )
    hits = F.filter(matched, lambda m: F.size(m["matches"]) > 0)
    return F.when(F.rlike(stream, F.lit(any_gate)), hits)


def detect(
    docs: DataFrame, text: str = "text", rules: list[dict] | None = None,
    phrases: dict[str, str] | None = None,
) -> DataFrame:
    """Each surviving detection with its row of `docs`, whose text is left out.

    Adds row (a number for the row of `docs`), n_words, phrase_places (n, first, last,
    labels), and rule, label, score, start and end (places in the word stream); a row
    without detections appears once, with these five null.
    """
    rules = signature_rules() if rules is None else rules
    phrases = PHRASES if phrases is None else phrases
    carried = [c for c in docs.columns if c != text]
    read = docs.select(
        F.struct(*carried).alias("carried") if carried else F.lit(None).alias("carried"),
        word_stream(F.col(text)).alias("stream"),
    ).withColumn("row", F.monotonically_increasing_id())
    read = read.withColumn("n_words", words_in(F.col("stream")) - 1)
    places = phrase_places(F.col("stream"), F.col("n_words"), phrases)
    found = read.select(
        "row",
        "carried",
        "n_words",
        F.struct(*[c.alias(k) for k, c in places.items()]).alias("phrase_places"),
        F.explode_outer(gated_matches(F.col("stream"), rules)).alias("hit"),
    )
    each = found.select(
        "row",
        "carried",
        "n_words",
        "phrase_places",
        "hit.rule",
        "hit.label",
        "hit.score",
        F.posexplode_outer(
            F.transform(
                F.col("hit.matches"),
                lambda m, k: F.struct(
                    F.length(m).alias("length"),
                    F.length(F.get(F.col("hit.gaps"), k)).alias("gap"),
                ),
            )
        ).alias("k", "span"),
    )
    along = Window.partitionBy("row", "rule").orderBy("k")
    by_start = Window.partitionBy("row").orderBy("start", F.desc("end"), "rule")
    placed = (
        each.repartition("row")
        .withColumn("end", F.sum(F.col("span.gap") + F.col("span.length")).over(along))
        .withColumn("start", F.col("end") - F.col("span.length"))
        .withColumn(
            "covered", F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
        )
    )
    # Detections that overlap, directly or by others between them, are one chain.
    apart = F.col("covered").isNull() | (F.col("covered") <= F.col("start"))
    chains = (
        placed.withColumn("chain", F.sum(F.when(apart, 1).otherwise(0)).over(by_start))
        .groupBy("row", "chain")
        .agg(
            F.first("carried").alias("carried"),
            F.first("n_words").alias("n_words"),
            F.first("phrase_places").alias("phrase_places"),
            F.array_sort(
                F.collect_list(
                    F.when(
                        F.col("end").isNotNull(),
                        F.struct("rule", "start", (-F.col("end")).alias("before"), "label", "score", "end"),
                    )
                )
            ).alias("hits"),
        )
    )
    return chains.select(
        "row", "carried", "n_words", "phrase_places", F.explode_outer(_resolved(F.col("hits"))).alias("hit")
    ).select(
        "row", "carried", "n_words", "phrase_places", "hit.rule", "hit.label", "hit.score", "hit.start", "hit.end"
    )


def _resolved(hits: Column) -> Column:
    """Hits in rule order, without those that overlap one kept before."""
    overlaps = lambda kept, hit: F.exists(
        kept, lambda k: (k["start"] < hit["end"]) & (hit["start"] < k["end"])
    )
    return F.aggregate(
        hits,
        F.slice(hits, 1, 0),
        lambda kept, hit: F.when(overlaps(kept, hit), kept).otherwise(F.concat(kept, F.array(hit))),
    )


def summarise(detections: DataFrame) -> DataFrame:
    """One row for each row of the detected documents: places, labels and score."""
    rows = detections.groupBy("row").agg(
        F.first("carried").alias("carried"),
        F.first("n_words").alias("n_words"),
        F.first("phrase_places").alias("places"),
        F.collect_set("label").alias("found"),
        F.max("score").alias("best"),
    )
    base = F.col("places.labels")
    return rows.select(
        "carried",
        "n_words",
        F.col("places.n").alias("n_base"),
        F.col("places.first").alias("first_word"),
        F.col("places.last").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.col("found"))), ",").alias("labels"),
        F.coalesce("best", F.when(F.size(base) > 0, 0.5).otherwise(0.0)).alias("score"),
    )
