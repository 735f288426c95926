"""Licence scans: hand-made texts, odd rows."""

import textwrap

from spanroute.llm.licenses import ALL_RULES, KNOWN, RULES, SENTENCES, scan_licenses

MIT = f"The MIT License\n\nCopyright (c) 2020 X\n\n{SENTENCES['mit-grant']}:\n\n{SENTENCES['mit-notice'].upper()}.\n{SENTENCES['mit-as-is']}"


def test_rules_and_order(spark):
    bsd = [SENTENCES[s] for s in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")]
    rows = [
        (1, MIT), (2, ". ".join(bsd)), (3, ".\n".join(bsd[:3]) + "."), (4, "Released under the MIT License. All rights reserved.  Licensed under CC BY-NC 4.0."),
        (5, "prose about the mit license here"), (6, "This Work is licensed, under the GNU General  Public License, Version 3!\nx " + "y " * 100_000), (7, None), (7, ""),
        (8, "* Licensed under the Apache License, Version 2.0 (the \"License\");\n* you may not use this file except in compliance with the License."),
        (9, "All rights reserved.\n" * 3), (9, "All rights reserved.\n" * 3), (None, "All rights reserved"),
    ]
    docs = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, rules int, TEXT string")
    got = sorted(map(tuple, scan_licenses(docs).collect()), key=str)
    assert got == sorted([
        (1, 4, "mit-full", "MIT"), (2, 4, "bsd-3-clause", "BSD-3-Clause"), (3, 3, "bsd-2-clause", "BSD-2-Clause"),
        (4, 3, "mit-released,cc-by-nc,reserved", "CC-BY-NC-4.0,LicenseRef-all-rights-reserved,MIT"), (5, 0, "", ""), (6, 1, "gpl-3-work", "GPL-3.0-only"),
        (7, 0, "", ""), (7, 0, "", ""), (8, 2, "apache-header", "Apache-2.0"), (9, 3, "reserved", "LicenseRef-all-rights-reserved"),
        (9, 3, "reserved", "LicenseRef-all-rights-reserved"), (None, 1, "reserved", "LicenseRef-all-rights-reserved"),
    ], key=str)
    assert scan_licenses(docs.limit(0)).count() == 0


def test_tables():
    assert all(s in SENTENCES for _, _, ids in RULES for s in ids)
    assert len(set(SENTENCES.values())) == len(SENTENCES)
    assert len({t for _, t in KNOWN}) == len(KNOWN) and len({r for r, _, _ in ALL_RULES}) == len(ALL_RULES)
    assert {i for _, _, ids in ALL_RULES for i in ids} <= {i for i, _ in KNOWN}


def gnu(kind, version, mark=","):
    return f"This program is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} Public License as published by the Free Software Foundation{mark} either version {version} of the License, or (at your option) any later version."


WRAPPED = {
    "MIT": """MIT License

        Copyright (c) 2021 Someone

        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

        The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE.""",
    "ISC": "Copyright (c) 2004 Someone\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

        1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

        (2) Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

        3. Neither the name of Some Body, Inc nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.""",
    "Apache-2.0": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy',
    "GPL-3.0-or-later": gnu("General", 3), "GPL-2.0-or-later": gnu("General", 2, ";").replace("software:", "software;"), "LGPL-2.1-or-later": gnu("Lesser General", "2.1"), "AGPL-3.0-or-later": gnu("Affero General", 3),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
    "CC-BY-NC-SA-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0 International.",
}


def test_wrapped_texts(spark):
    """Standard texts as files have them: wrapped, indented, behind marks of comments, with either line end."""
    rows, want = [], {}
    for name, text in WRAPPED.items():
        for width in (40, 72, 10_000):
            for lead, end in (("", "\n"), (" * ", "\n"), ("# ", "\n"), ("// ", "\r\n"), (";; ", "\n")):
                lines = [x for part in text.split("\n\n") for x in [*textwrap.wrap(part.strip(), width, break_on_hyphens=False), ""]]
                want[len(rows)] = name
                rows.append((len(rows), end.join(f"{lead}{x}".rstrip() if lead else x for x in ["", *lines])))
    got = {r.doc_id: r.licences for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: (n, got[i]) for i, n in want.items() if got[i] != n} == {}
    titles = ["Apache License\n   Version 2.0, January 2004\nhttp://www.apache.org/licenses/\n\nTERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n", "GNU GENERAL PUBLIC LICENSE\n  Version 3, 29 June 2007\n\nCopyright", "Mozilla Public License Version 2.0\n====\n", "Creative Commons Legal Code\n\nCC0 1.0 Universal\n", "This project is released under the MIT license.", "An end of the line:\nLicensed under CC BY 4.0\nand more"]
    got = [r.licences for r in scan_licenses(spark.createDataFrame(list(enumerate(titles)), "doc_id long, text string").coalesce(1)).sort("doc_id").collect()]
    assert got == ["Apache-2.0", "GPL-3.0-only", "MPL-2.0", "CC0-1.0", "MIT", "CC-BY-4.0"]


def test_known_sentences_hold_a_hint():
    from spanroute.llm import licenses as L

    assert [t for _, t in KNOWN if not any(w.split()[-1] in t for w in L.WORDS)] == []
    assert len(KNOWN) < 5_000


def bsd3(owner):
    return WRAPPED["BSD-3-Clause"].replace("Some Body, Inc", owner)


SAID = {
    "SPDX-License-Identifier: MIT": "MIT", "// SPDX-License-Identifier: Apache-2.0": "Apache-2.0", "# SPDX-License-Identifier: GPL-2.0-or-later": "GPL-2.0-or-later", "/* SPDX-License-Identifier: MIT OR Apache-2.0 */": "Apache-2.0 OR MIT",
    "License: MIT": "MIT", "## License: BSD-3-Clause": "BSD-3-Clause", '  "license": "ISC",': "ISC", "Licence: MPL-2.0": "MPL-2.0", "MIT licensed.": "MIT", "MIT License": "MIT",
    "This project is licensed under the MIT License - see the [LICENSE](LICENSE) file for details.": "MIT", "Released under the [MIT License](LICENSE).": "MIT", "Licensed under the terms of the MIT license.": "MIT",
    "The code is available under the Boost Software License, Version 1.0.": "BSL-1.0", "This program is distributed under the Eclipse Public License 2.0.": "EPL-2.0", "Released under the zlib license": "Zlib",
    "Licensed under CC BY-SA 3.0": "CC-BY-SA-3.0", "This work is licensed under a Creative Commons Attribution 3.0 Unported License.": "CC-BY-3.0", "https://creativecommons.org/licenses/by-nc/4.0/": "CC-BY-NC-4.0",
    "To view a copy of this license, visit http://creativecommons.org/licenses/by-nd/2.5/": "CC-BY-ND-2.5", "https://creativecommons.org/publicdomain/zero/1.0/": "CC0-1.0", "Available under the SIL Open Font License, Version 1.1.": "OFL-1.1",
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:": "Zlib",
    "The GNU General Public License is a free, copyleft license for\nsoftware and other kinds of works.": "GPL-3.0-only", '"This License" refers to version 3 of the GNU General Public License.': "GPL-3.0-only",
    "The licenses for most software are designed to take away your\nfreedom to share and change it.": "GPL-2.0-only", "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such Derivative Works in Source or Object form.": "Apache-2.0",
    "This version of the GNU Lesser General Public License incorporates\nthe terms and conditions of version 3 of the GNU General Public\nLicense, supplemented by the additional permissions listed below.": "LGPL-3.0-only",
    "Each Contributor hereby grants You a world-wide, royalty-free,\nnon-exclusive license:": "MPL-2.0", "we talked about a license and software": "", "the license: is one": "",
}


def test_owners_and_notices(spark):
    """Owners with full stops in their names, tags, links, notices, addresses and bodies without titles."""
    owners = ["Google Inc.", "Acme Ltd.", "the Foo Project", "The Regents of the University of California", "Foo, Bar & Co. e.V.", "A. B. Smith"]
    rows = []
    for owner in owners:
        for width in (40, 76):
            for lead in ("", " * ", "# "):
                lines = [x for part in bsd3(owner).split("\n\n") for x in [*textwrap.wrap(part.strip(), width), ""]]
                rows.append(("BSD-3-Clause", "\n".join((lead + x).rstrip() for x in lines)))
    author = WRAPPED["BSD-3-Clause"].rsplit("3.", 1)[0] + "3. The name of the author may not be used to endorse or promote products derived from this software without specific prior written permission."
    rows += [("BSD-3-Clause", author), *((v, f"Some words.\n\n{k}\n\nMore words.") for k, v in SAID.items())]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r.licences for r in scan_licenses(docs).collect()}
    assert {t[:60]: (want, got[i]) for i, (want, t) in enumerate(rows) if got[i] != want} == {}


def test_sql_says_the_same(spark, tmp_path):
    import duckdb

    from spanroute.llm.licenses import oracle

    texts = [*SAID, *WRAPPED.values(), *(bsd3(o).replace(" name ", "\n  * name ") for o in ("Google Inc.", "X")), "[a](b)\n[c](\nd)", "see the license", "x see the copying", None, "License : [MIT](x) see the license -"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    con = duckdb.connect()
    docs.coalesce(1).write.parquet(str(tmp_path / "d"))
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    want = con.execute(oracle())
    got = scan_licenses(docs).select(*[d[0] for d in want.description])
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
