"""License wordings outside the training recipe, by hand: recall of the families, precision on texts that grant nothing, versions."""

from kinweave.llm import licenses

HELD_OUT = [
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("BSD", "This tool is licensed under the BSD 2-Clause license"),
    ("GPL", "The firmware was released under the GNU GPL v2 license."),
    ("GPL", "// SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL", "# SPDX-License-Identifier: GPL-3.0-or-later"),
    ("Apache-2.0", "/* SPDX-License-Identifier: Apache-2.0 */"),
    ("LGPL", "SPDX-License-Identifier: LGPL-2.1-or-later"),
    ("MPL-2.0", "This library is licensed under the MPL 2.0 by its authors"),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("BSD", "All code here is licensed under the BSD 3-Clause license, see below."),
    ("MIT", "Unless noted, everything is released under the MIT License, copyright 2019 by the authors."),
    ("Apache-2.0", "Copyright 2020 X. Licensed under the Apache License, Version 2.0 (the \"License\");"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL", "You can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or later."),
    ("MIT", "Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software and associated\ndocumentation files (the Software), to deal in the Software"),
    ("AGPL-3.0", "The server is licensed under the GNU AGPL v3 or later"),
    ("CC-BY-SA", "Texts: licensed under CC BY-SA 4.0, pictures excluded."),
    ("CC-BY", "SPDX-License-Identifier: CC-BY-4.0"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy it."),
    ("CC0", "Data: CC0 1.0 Universal public domain dedication"),
    ("ISC", "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that"),
    ("BSD", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without prior written permission."),
]
NOTHING = [
    "The fishing license was released under the old law.", "He is licensed under the state board of medicine.", "Students of MIT released a film.", "The General gave a public speech on the license fees.", "Version 2 of the story has a better end.",
    "SPDX-License-Identifier: Zlib", "A license plate with the number GPL 3 was seen.", "Use of the software is free of charge for students.", "You may not use this entrance.", "All parties are subject to the terms of the treaty.", "The Apache people live in the south west.",
    "The commons of the town are open to creative minds.", "Permission is needed to enter.", "Redistribution of wealth is a matter of politics.", "This work is under way.", "The names of its members may be used in print.", "Public domain is a legal term.", "Released in 1999, the song became a hit.", "",
    "A copy of this letter was sent to any person in the building free of charge",
]


def test_held_out_wordings(spark):
    texts = [t for _, t in HELD_OUT] + NOTHING
    got = {x.doc_id: x for x in licenses.report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    missed = [(f, got[i].licenses, t) for i, (f, t) in enumerate(HELD_OUT) if got[i].licenses != f]
    wrong = [(got[len(HELD_OUT) + i].licenses, t) for i, t in enumerate(NOTHING) if got[len(HELD_OUT) + i].licenses]
    assert len(missed) <= 1 and len(wrong) <= 1, (missed, wrong)
    assert [got[i].versions for i in (0, 1, 2, 3, 4, 9)] == ["", "BSD-2", "GPL-2", "GPL-2", "GPL-3", "BSD-3"]


def test_only_texts_that_speak_of_licenses_have_one(spark, tiny):
    table = spark.read.parquet(f"{tiny}/documents.parquet")
    found = licenses.report(table).where("n_paragraphs > 0").join(table.select("doc_id", "text"), "doc_id").collect()
    assert found and all(any(w in x.text.lower() for w in ("licen", "public domain", "permission")) for x in found)
