from tidemark.llm import licenses

MIT = """MIT License

Copyright (c) 2020 Someone

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED."""
BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that:
1. Redistributions of source code must retain the above copyright notice, this list of conditions.
2. Redistributions in binary form must reproduce the above copyright notice in the documentation.
{}THIS SOFTWARE IS PROVIDED BY THE HOLDERS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."""
ENDORSE = "3. Neither the name of X nor the names of its contributors may be used to endorse or promote products derived from this software.\n"
GPL = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License
as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty.
You should have received a copy of the GNU General Public License along with this program."""


def names(frame, texts):
    rows = licenses.licenses(frame(list(enumerate(texts)))).collect()
    return [r.licenses for r in sorted(rows, key=lambda r: r.doc_id)]


def test_full_texts(frame):
    assert names(frame, [MIT, BSD.format(ENDORSE), BSD.format(""), GPL]) == ["MIT", "BSD-3-Clause", "BSD-2-Clause", "GPL-3.0-or-later"]


def test_references(frame):
    texts = {
        "Before. Licensed under CC BY-NC 4.0.\nAfter.": "CC-BY-NC",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "Words.\nLicensed under the Apache Licence, Version 2.0.": "Apache-2.0",
        "Released under the MIT License. All rights reserved.": "All-Rights-Reserved,MIT",
        "Released under the MIT License.\nReleased under the MIT License.": "MIT",
        "It is dedicated to the public domain.": "Public-Domain",
        "A driver's licence is needed.": "",
        "no words of that kind": "",
    }
    assert names(frame, list(texts)) == list(texts.values())


def test_unmatched_and_open(frame):
    rows = {r.doc_id: r for r in licenses.licenses(frame([(1, "Some own license applies here."), (2, MIT), (3, GPL), (4, "x")])).collect()}
    assert (rows[1].n_unmatched, rows[1].open) == (1, None)
    assert rows[2].open is True and rows[3].open is False and rows[4].open is None


def test_odd_rows(frame, odd_texts):
    rows = licenses.licenses(frame(odd_texts + [(20, "license " * 30000)])).collect()
    assert len(rows) == len(odd_texts) + 1 and {r.licenses for r in rows} == {""}
    assert licenses.licenses(frame([])).count() == 0


def test_short_references_without_the_word_licence(frame):
    texts = {
        "Available under CC BY-SA 4.0.": "CC-BY-SA",
        "Usable under CC BY-NC.": "CC-BY-NC",
        "Distributed under the BSD.": "BSD",
        "Released under the MIT terms.": "MIT",
        "Released under the terms of the ISC.": "ISC",
        "Released under mitigating circumstances.": "",
    }
    assert names(frame, list(texts)) == list(texts.values())


WRAPPED = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit-notice",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc-grant",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd-redistribute",
    "redistributions of source code must retain the above copyright notice": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice": "bsd-binary",
    "neither the name of x may be used to endorse or promote products derived from this software": "bsd-endorse",
    "the software is provided as is without warranty of any kind": "asis",
    "permission is granted to anyone to use this software for any purpose including commercial applications": "zlib-grant",
    "released under the apache license 2.0": "apache-2.0",
    "you may not use this file except in compliance with the license": "apache-comply",
    "you may obtain a copy of the license at x": "apache-obtain",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis": "apache-asis",
    "under the gnu affero general public license version 3 or any later version": "agpl-3-later",
    "under the gnu affero general public license version 3": "agpl-3",
    "under the gnu lesser general public license version 3 or any later version": "lgpl-later",
    "under the gnu lesser general public license version 3": "lgpl-3",
    "under the gnu library general public license version 2": "lgpl-2.1",
    "under the gnu general public license version 3 or any later version": "gpl-3-later",
    "under the gnu general public license version 2 or any later version": "gpl-2-later",
    "under the gnu general public license version 3": "gpl-3",
    "under the gnu general public license version 2": "gpl-2",
    "terms of the gnu general public license": "gpl-any",
    "this library is distributed in the hope that it will be useful": "gpl-warranty",
    "you should have received a copy of the gnu x license": "gpl-copy",
    "under mozilla public license 2.0": "mpl-2.0",
    "given as creative commons zero": "cc0",
    "under a creative commons attribution noncommercial noderivatives": "cc-by-nc-nd",
    "under a creative commons attribution noncommercial sharealike": "cc-by-nc-sa",
    "under a creative commons attribution noncommercial": "cc-by-nc",
    "under a creative commons attribution sharealike": "cc-by-sa",
    "under a creative commons attribution noderivatives": "cc-by-nd",
    "under a creative commons attribution": "cc-by",
    "released under the mit": "mit",
    "released under the isc": "isc",
    "released under the bsd": "bsd",
    "placed in the public domain": "public-domain",
    "all rights reserved": "reserved",
    "some licensing of ours": "mention",
}


def test_wrapped_lines_of_every_identifier(frame):
    assert list(WRAPPED.values()) == [name for name, _ in licenses.SENTENCES]
    rows = licenses.licenses(frame([(k, t.replace(" ", "\n")) for k, t in enumerate(WRAPPED)])).collect()
    assert [r.sentence_ids for r in sorted(rows, key=lambda r: r.doc_id)] == list(WRAPPED.values())
