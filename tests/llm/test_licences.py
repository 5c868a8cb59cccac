import textwrap

from kilowatch.llm import licences
from kilowatch.llm.common import table
from tests.compare import connect, differences
from tests.conftest import SF_DIR
from tests.llm.fixtures import documents, frame, with_clashes

KNOWN = dict(licences.SENTENCES)


def scan(spark, texts):
    rows = licences.license_scan(with_clashes(documents(spark, texts), "ids", "found", "licence")).collect()
    return {r["doc_id"]: (r["licence"], r["licences"]) for r in rows}


def test_every_rule_fires_on_its_own_sentences(spark):
    texts = ["\n".join(KNOWN[i] for i in ids) for _, ids in licences.RULES]
    got = scan(spark, texts)
    for i, (name, _) in enumerate(licences.RULES):
        assert name in got[i][1].split(",")


def test_order_noise_and_absence(spark):
    grant, notice = KNOWN["mit-grant"], KNOWN["mit-notice"]
    texts = [
        f"Some words.\n{grant.upper()}\nunrelated line. {notice} more", "We released under the mit license, they say.", None, "",
        "All rights reserved.\nReleased under the MIT License.", "x. All rights  RESERVED!! y", "gnu general public license", "word " * 200_000,
        f"{KNOWN['bsd-binary']}\n{KNOWN['bsd-source']}\n{KNOWN['bsd-grant']}",
    ]
    got = scan(spark, texts)
    assert got[0] == ("MIT", "MIT") and got[4] == ("MIT", "MIT,All-Rights-Reserved") and got[5][0] == "All-Rights-Reserved"
    assert all(got[i] == (None, "") for i in (1, 2, 3, 6, 7, 8))


def test_table_is_sound():
    names, forms = zip(*licences.known_sentences(licences.SENTENCES))
    assert len(set(names)) == len(names) and len(set(forms)) == len(forms) and not any("," in n for n in names)
    assert all(i in names for _, ids in licences.RULES for i in ids)


def test_equals_sql_and_empty(spark):
    docs = table(spark, SF_DIR, "documents")
    assert differences(licences.license_scan(docs), connect(SF_DIR), licences.oracle()) == []
    assert licences.license_scan(frame(spark, [])).collect() == []


def wrapped(text, mark, width=72):
    return "\n".join(mark + line for line in textwrap.wrap(text, width))


def test_wrapped_and_commented_sentences(spark):
    rules = [ids for _, ids in licences.RULES]
    plain = scan(spark, ["\n".join(KNOWN[i] for i in ids) for ids in rules])
    for mark, width, end in (("", 72, "\n"), ("# ", 40, "\n"), (" * ", 76, "\r\n"), ("// ", 60, "\r")):
        got = scan(spark, [f"\n{mark}\n".join(wrapped(KNOWN[i], mark, width) for i in ids).replace("\n", end) for ids in rules])
        assert got == plain, mark


def test_licences_as_printed(spark):
    bsd = """Copyright (c) 2020, A. Author

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
    endorse = "3. " + wrapped(KNOWN["bsd-endorse"], "   ").strip()
    gpl = wrapped(f"{KNOWN['gpl-warranty']}  {KNOWN['gpl-details']}", "# ")
    mpl = wrapped(f"{KNOWN['mpl-2.0-header']} If a copy of the MPL was not distributed with this file, You can obtain one at x.", " * ")
    isc = "ISC License\n\nCopyright (c) 2020 A. Author\n\n" + wrapped(KNOWN["isc-grant"], "")
    torn = bsd.replace("provided that the", "provided\n\nthat the")
    got = scan(spark, [bsd, bsd + endorse, gpl, f"/*\n{mpl}\n */", isc, "The\nMIT License\n(MIT)", torn])
    assert [got[i][0] for i in range(7)] == ["BSD-2-Clause", "BSD-3-Clause", "GPL", "MPL-2.0", "ISC", "MIT", None]


def test_part_of_a_cut_sentence_names_nothing(spark):
    warranty = KNOWN["gpl-warranty"].replace("; without", ";\nunrelated line\nwithout")
    got = scan(spark, ["Name: x\nVersion: 2.0", "2.0", "v. 2.0.", f"{warranty}\n{KNOWN['gpl-details']}", f"{KNOWN['mit-grant']}\n2.0\n{KNOWN['mit-notice']}", KNOWN["mpl-2.0-header"]])
    assert [got[i][0] for i in range(6)] == [None, None, None, None, "MIT", "MPL-2.0"]
