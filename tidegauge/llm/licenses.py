"""License scan: ordered signature rules behind a keyword filter.

A rule is a pattern over lower-case words with one keyword in braces. A text without any keyword is left at once. At
each keyword the rules of that keyword are tried on the words before and after it, so every match has an exact interval
of words. Overlaps are resolved by priority: a detection inside the interval of another one of the same or a higher
priority is suppressed; of equal intervals and priorities the earlier rule stays.

Everything is DataFrame operations; the rules are a small table of fixed size. Rows: a NULL or blank text has no words,
no labels and score 0; repeated rows are judged each by itself; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegauge.llm.common import alnum_words

#: Words on either side of a keyword that a rule can reach.
REACH = 14
#: Base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
BASE_SCORE = 0.6

TAG, NAMED, HINT = 3, 2, 1
CONFIDENCE = {TAG: 1.0, NAMED: 0.9, HINT: 0.4}

GNU = {
    "gpl": ("", ("1.0", "2.0", "3.0")),
    "lgpl": ("(?:lesser |library )", ("2.0", "2.1", "3.0")),
    "agpl": ("affero ", ("1.0", "3.0")),
}
CREATIVE = {
    "by": "attribution", "by-sa": "attribution share ?alike", "by-nc": "attribution non ?commercial",
    "by-nd": "attribution no ?derivat(?:ive|ives|es|e)", "by-nc-sa": "attribution non ?commercial share ?alike",
    "by-nc-nd": "attribution non ?commercial no ?derivat(?:ive|ives|es|e)",
}
CREATIVE_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
#: Names of licenses with versions: words with the keyword in braces, label, versions.
VERSIONED = (
    ("(?:the )?{apache}(?: software)?(?: public)? license", "apache", ("1.0", "1.1", "2.0")),
    ("(?:the )?{mozilla} public license", "mpl", ("1.0", "1.1", "2.0")),
    ("(?:the )?{eclipse} public license", "epl", ("1.0", "2.0")),
    ("(?:the )?common {development} and distribution license", "cddl", ("1.0", "1.1")),
    ("(?:the )?{european} union public licen[cs]e", "eupl", ("1.0", "1.1", "1.2")),
    ("(?:the )?{artistic} license", "artistic", ("1.0", "2.0")),
    ("(?:the )?{boost} software license", "bsl", ("1.0",)),
    ("(?:the )?open {software} license", "osl", ("1.0", "1.1", "2.0", "2.1", "3.0")),
    ("(?:the )?{academic} free license", "afl", ("1.1", "1.2", "2.0", "2.1", "3.0")),
    ("(?:the )?{python} software foundation license", "psf", ("2.0",)),
    ("(?:the )?{php} license", "php", ("3.0", "3.01")),
    ("(?:the )?{zope} public license", "zpl", ("1.1", "2.0", "2.1")),
    ("(?:the )?sil open {font} license", "ofl", ("1.0", "1.1")),
    ("(?:the )?open {database} license", "odbl", ("1.0",)),
    ("(?:the )?{ibm} public license", "ipl", ("1.0",)),
    ("(?:the )?{lucent} public license", "lpl", ("1.0", "1.02")),
    ("(?:the )?{cecill}(?: free software)? license", "cecill", ("1.0", "1.1", "2.0", "2.1")),
    ("(?:the )?{mulan} permissive software license", "mulan", ("1.0", "2.0")),
    ("(?:the )?{latex} project public license", "lppl", ("1.0", "1.1", "1.2", "1.3")),
    ("(?:the )?gnu free {documentation} license", "gfdl", ("1.1", "1.2", "1.3")),
)
#: Phrases of licenses and notices without a version.
PLAIN = (
    (NAMED, "(?:the )?{mit} license", "mit"), (NAMED, "(?:the )?{mit} x11 license", "mit-x11"),
    (NAMED, "{permission} is hereby granted free of charge to any person obtaining a copy", "mit"),
    (NAMED, "{permission} to use copy modify and or distribute this software for any purpose", "isc"),
    (NAMED, "(?:the )?{isc} license", "isc"), (NAMED, "(?:the )?{zlib} license", "zlib"),
    (NAMED, "(?:the )?{libpng} license", "libpng"), (NAMED, "(?:the )?{unlicense}", "unlicense"),
    (NAMED, "(?:the )?{ncsa} open source license", "ncsa"), (NAMED, "(?:the )?{postgresql} license", "postgresql"),
    (NAMED, "(?:the )?{openssl} license", "openssl"), (NAMED, "(?:the )?{vim} license", "vim"),
    (NAMED, "(?:the )?{ruby} license", "ruby"), (NAMED, "(?:the )?{json} license", "json"),
    (NAMED, "(?:the )?{beerware} license", "beerware"), (NAMED, "microsoft {public} license", "ms-pl"),
    (NAMED, "microsoft {reciprocal} license", "ms-rl"), (NAMED, "(?:the )?{curl} license", "curl"),
    (NAMED, "do what the fuck you want to public {license}", "wtfpl"),
    (NAMED, "redistribution and use in {source} and binary forms with or without modification", "bsd"),
    (NAMED, "(?:the )?{bsd} license", "bsd"), (NAMED, "(?:the )?(?:new|revised|modified) {bsd} license", "bsd-3-clause"),
    (NAMED, "(?:the )?(?:simplified|freebsd) {bsd} license", "bsd-2-clause"),
    (NAMED, "(?:the )?{bsd} (?:0|zero) clause(?: license)?", "0bsd"),
    (NAMED, "(?:the )?{bsd} (?:2|two) clause(?: license)?", "bsd-2-clause"),
    (NAMED, "(?:the )?{bsd} (?:3|three) clause(?: license)?", "bsd-3-clause"),
    (NAMED, "(?:the )?{bsd} (?:4|four) clause(?: license)?", "bsd-4-clause"),
    (NAMED, "(?:0|zero) clause {bsd}(?: license)?", "0bsd"), (NAMED, "(?:2|two) clause {bsd}(?: license)?", "bsd-2-clause"),
    (NAMED, "(?:3|three) clause {bsd}(?: license)?", "bsd-3-clause"),
    (NAMED, "(?:4|four) clause {bsd}(?: license)?", "bsd-4-clause"),
    (NAMED, "creative {commons} zero(?: v?1 0)?", "cc0-1.0"), (NAMED, "{cc0}(?: 1 0)?(?: universal)?", "cc0-1.0"),
    (NAMED, "(?:dedicated to|released into|placed in|in) the public {domain}", "public-domain"),
    (NAMED, "public {domain} dedication", "public-domain"), (NAMED, "open {data} commons attribution license", "odc-by"),
    (NAMED, "public {domain} dedication and license", "pddl"),
    (HINT, "all rights {reserved}", "rights-reserved"), (HINT, "{copyright} (?:c )?(?:19|20)[0-9]{2}", "copyright"),
    (HINT, "{copyright} (?:c )?by", "copyright"), (HINT, "{proprietary} and confidential", "proprietary"),
    (HINT, "(?:strictly )?{confidential} information", "proprietary"),
    (HINT, "for {internal} use only", "proprietary"), (HINT, "may not be {reproduced}", "rights-reserved"),
    (HINT, "subject to the terms of the {license}", "license-terms"), (HINT, "see the {license} file", "license-file"),
    (HINT, "licensed under (?:the|a) {license}", "license-terms"), (HINT, "end user {license} agreement", "eula"),
    (HINT, "{licensed} under the", "license-notice"), (HINT, "without {warranty} of any kind", "disclaimer"),
    (HINT, "without even the implied {warranty}", "disclaimer"), (HINT, "provided as is without {warranty}", "disclaimer"),
    (HINT, "{lizenziert} unter", "license-notice"), (HINT, "alle rechte {vorbehalten}", "rights-reserved"),
    (HINT, "tous droits {réservés}", "rights-reserved"), (HINT, "sous {licence}", "license-notice"),
    (HINT, "todos los derechos {reservados}", "rights-reserved"), (HINT, "bajo {licencia}", "license-notice"),
)
#: Further short identifiers that appear in license tags.
TAGGED = (
    "MIT", "MIT-0", "MIT-CMU", "ISC", "0BSD", "BSD-1-Clause", "BSD-2-Clause", "BSD-2-Clause-Patent", "BSD-3-Clause",
    "BSD-3-Clause-Clear", "BSD-4-Clause", "Zlib", "Libpng", "Unlicense", "WTFPL", "NCSA", "PostgreSQL", "OpenSSL", "Vim",
    "Ruby", "JSON", "Beerware", "MS-PL", "MS-RL", "curl", "X11", "CC0-1.0", "PDDL-1.0", "ODC-By-1.0", "Artistic-1.0-Perl",
    "Python-2.0", "CNRI-Python", "Intel", "Naumen", "Sleepycat", "SISSL", "Watcom-1.0", "QPL-1.0", "RPL-1.5", "NPL-1.1",
    "UPL-1.0", "BlueOak-1.0.0", "HPND", "ICU", "TCL", "Unicode-DFS-2016", "W3C", "Xnet", "Fair", "EFL-2.0",
)


def spaced(identifier: str) -> str:
    return identifier.lower().replace("-", " ").replace(".", " ")


def version_words(version: str) -> str:
    """``2.0`` is also written 2, v2, version 2.0."""
    major, minor = version.split(".")
    tail = "(?: 0)?" if minor == "0" else f" {minor}"
    return f"(?: |,? version |,? v)(?:v)?{major}{tail}".replace(",?", "")


def rule_texts() -> list[tuple[int, str, str]]:
    """(priority, pattern, label) of all rules, in order."""
    tag = "{spdx} license identifier "
    rules: list[tuple[int, str, str]] = []
    for name, (kind, versions) in GNU.items():
        full = f"(?:the )?(?:gnu )?{kind}{{general}} public license"
        for v in versions:
            rules += [
                (TAG, f"{tag}{spaced(f'{name}-{v}')}(?: only)?", f"{name}-{v}"),
                (TAG, f"{tag}{spaced(f'{name}-{v}')} or later", f"{name}-{v}-or-later"),
                (NAMED, f"{full}{version_words(v)}", f"{name}-{v}"),
                (NAMED, f"{full}{version_words(v)} or (?:at your option )?(?:any )?later(?: version)?", f"{name}-{v}-or-later"),
                (NAMED, f"version {v.replace('.0', '')}(?: of)? {full}", f"{name}-{v}"),
                (NAMED, f"(?:gnu )?{{{name}}}{version_words(v)}", f"{name}-{v}"),
                (NAMED, f"(?:gnu )?{{{name}v{v[0]}}}", f"{name}-{v}") if v.endswith(".0") else
                (NAMED, f"(?:gnu )?{{{name}v{v[0]}}} {v[2:]}", f"{name}-{v}"),
            ]
        rules += [(NAMED, full, name), (HINT, f"(?:gnu )?{{{name}}} licen[sc]ed?", name)]
    for name, words in CREATIVE.items():
        for v in CREATIVE_VERSIONS:
            label = f"cc-{name}-{v}"
            rules += [
                (TAG, tag + spaced(label), label), (NAMED, f"creative {{commons}} {words}{version_words(v)}", label),
                (NAMED, f"{{cc}} {spaced(name)} {spaced(v)}", label),
            ]
        rules += [(NAMED, f"creative {{commons}} {words}", f"cc-{name}"), (NAMED, f"{{cc}} {spaced(name)}", f"cc-{name}")]
    for words, name, versions in VERSIONED:
        for v in versions:
            rules += [(TAG, tag + spaced(f"{name}-{v}"), f"{name}-{v}"), (NAMED, words + version_words(v), f"{name}-{v}")]
        rules.append((NAMED, words, name))
    rules += [(TAG, tag + spaced(i), i.lower()) for i in TAGGED]
    rules += list(PLAIN)
    return rules


def rule_rows() -> list[tuple[int, int, float, str, str, str, str]]:
    """(rule, priority, confidence, label, keyword, pattern before it, pattern behind it)."""
    out = []
    for number, (priority, text, label) in enumerate(rule_texts()):
        before, rest = text.split("{", 1)
        keyword, after = rest.split("}", 1)
        out.append((number, priority, CONFIDENCE[priority], label, keyword, f"(?:^| )({before})$", f"^({after})(?: |$)"))
    return out


RULES = (
    "rule int, priority int, confidence double, label string, keyword string, before_pattern string, after_pattern string"
)


def keywords() -> list[str]:
    return sorted({r[4] for r in rule_rows()})


def base_places(words: Column, phrase: str) -> Column:
    """Where ``phrase`` stands in ``words``, from 0; only texts that hold its words are searched."""
    parts = phrase.split(" ")
    here = lambda i: reduce(
        lambda a, b: a & b, [F.get(words, i + k) == F.lit(p) for k, p in enumerate(parts)]
    )
    last = F.size(words) - len(parts)
    held = reduce(lambda a, b: a & b, [F.array_contains(words, p) for p in parts])
    nothing = F.array().cast("array<int>")
    return F.when(held & (last >= 0), F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), here)).otherwise(nothing)


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: base places and labels, and the labels and score of the rules."""
    spark = docs.sparkSession
    words = F.col("words")
    gate = F.array(*[F.lit(k) for k in keywords()])
    hits = F.filter(
        F.transform(words, lambda w, i: F.struct(w.alias("keyword"), i.alias("at"))),
        lambda x: F.array_contains(gate, x["keyword"]),
    )
    context = F.transform(hits, lambda x: F.struct(
        x["keyword"].alias("keyword"), x["at"].alias("at"),
        F.array_join(F.slice(words, F.greatest(x["at"] - REACH, F.lit(0)) + 1, F.least(x["at"], F.lit(REACH))), " ").alias("before"),
        F.array_join(F.slice(words, x["at"] + 2, REACH), " ").alias("after"),
    ))
    empty = F.array().cast("array<struct<keyword:string,at:int,before:string,after:string>>")
    places = [base_places(words, p) for p in BASE]
    found = F.concat(*places)
    labels = F.array_compact(F.array(*[F.when(F.size(p) > 0, label) for p, label in zip(places, BASE.values(), strict=True)]))
    rows = (
        docs.select("doc_id", alnum_words(F.col("text")).alias("words"))
        .withColumn("row", F.monotonically_increasing_id())
        .select(
            "row", "doc_id", F.size(words).cast("long").alias("n_words"), found.alias("places"), labels.alias("base"),
            F.when(F.arrays_overlap(words, gate), context).otherwise(empty).alias("context"),
        )
        .select(
            "row", "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
            F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
            "base", F.explode_outer("context").alias("c"),
        )
    )
    own = ["row", "doc_id", "n_words", "n_base", "first_word", "last_word", "base"]
    rules = F.broadcast(spark.createDataFrame(rule_rows(), RULES))  # a fixed list of some hundred rules
    before = F.when(F.col("c.before") == "", "").otherwise(F.concat("c.before", F.lit(" ")))
    after = F.when(F.col("c.after") == "", "").otherwise(F.concat(F.lit(" "), "c.after"))
    fits = F.regexp_like(before, F.col("before_pattern")) & F.regexp_like(after, F.col("after_pattern"))
    n_words = lambda text: F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))
    part = lambda text, pattern: F.call_function("regexp_extract", text, F.col(pattern), F.lit(1))
    tried = rows.join(rules, F.col("c.keyword") == F.col("keyword"), "left").withColumn("fits", F.coalesce(fits, F.lit(False)))
    matched = tried.select(
        *own, "rule", "priority", "confidence", "label", "fits",
        (F.col("c.at") - n_words(part(before, "before_pattern"))).alias("begin"),
        (F.col("c.at") + n_words(part(after, "after_pattern"))).alias("end"),
    )
    return resolved(matched, own)


def resolved(matched: DataFrame, own: list[str]) -> DataFrame:
    """Suppress contained detections and gather the labels of each text."""
    earlier = Window.partitionBy("row").orderBy(
        F.col("fits").desc(), "begin", F.col("end").desc(), F.col("priority").desc(), "rule"
    ).rowsBetween(Window.unboundedPreceding, -1)
    reach = lambda p: F.max(F.when(F.col("fits") & (F.col("priority") >= p), F.col("end"))).over(earlier)
    outer = F.when(F.col("priority") == TAG, reach(TAG)).when(F.col("priority") == NAMED, reach(NAMED)).otherwise(reach(HINT))
    judged = matched.withColumn("kept", F.col("fits") & ~F.coalesce(outer >= F.col("end"), F.lit(False)))
    text = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    ruled = F.collect_set(F.when(F.col("kept"), F.col("label")))
    return judged.groupBy(*own).agg(ruled.alias("ruled"), F.max(F.when(F.col("kept"), F.col("confidence"))).alias("best")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", text(F.col("base")).alias("base_labels"),
        text(F.concat("base", "ruled")).alias("labels"),
        F.greatest(F.coalesce("best", F.lit(0.0)), F.when(F.col("n_base") > 0, BASE_SCORE).otherwise(0.0)).alias("score"),
    )
