"""One sentence for each written rule, with the labels that it must have."""

import pytest

from kinweave.llm import licenses

EXAMPLES = """
apache-2.0 | Licensed under the Apache License, Version 2.0 (the "License");
apache-2.0 | Use it under the terms of the Apache License, Version 2.0.
apache,apache-2.0 | See the Apache License; you may not use this file except in compliance with the License.
apache-1.1 | The Apache Software License, Version 1.1
apache-1.0 | This product includes software developed by the Apache Group for use in its server.
apache | Distributed under the Apache License, as everyone knows.
mit | Permission is hereby granted, free of charge, to any person obtaining a copy of this software and files
mit | Released under the terms of the MIT License.
mit | Published under the MIT Licence.
mit-0 | MIT No Attribution
x11 | Except as contained in this notice, the name of the X Consortium shall not be used
isc | Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is granted
isc | Available under the ISC License.
bsd-4-clause | All advertising materials mentioning features or use of this software must display this
bsd-3-clause | Neither the name of the university nor the names of its contributors may be used to endorse
bsd-2-clause | Redistributions in binary form must reproduce the above copyright notice, this list
bsd-2-clause | Redistributions of source code must retain the above copyright notice
bsd | Licensed under a BSD license found elsewhere.
bsd | Use is governed by a BSD-style licence.
gpl-2.0-or-later,lgpl | Lesser General Public License: either version 2 of the License, or (at your option) any later version.
gpl,gpl-3.0-or-later | Under the terms of the GNU General Public License; either version 3 of the License, or (at your option) any later version.
agpl-3.0-or-later | GNU Affero General Public License as published, either version 3 of the License, or later
lgpl,lgpl-2.1-or-later | GNU Lesser General Public License; either version 2.1 of the License, or (at your option) any later version
gpl-3.0 | Licensed under the GNU General Public License, version 3.
gpl-2.0 | Licensed under the GNU General Public License version 2
gpl-3.0 | Under the terms of the GNU General Public License, version 3
gpl-2.0 | under the terms of GNU General Public License version 2
gpl | It is shared under the terms of the GNU General Public License.
lgpl-3.0 | Licensed under the GNU Lesser General Public License, version 3
lgpl-2.1 | licensed under the GNU Lesser General Public License version 2.1
lgpl | under the terms of the GNU Lesser General Public License
lgpl-2.0 | under the terms of the GNU Library General Public License
agpl-3.0 | Licensed under the GNU Affero General Public License, version 3
agpl | under the terms of the GNU Affero General Public License
gfdl | Copy it under the terms of the GNU Free Documentation License.
gfdl-1.3 | GNU Free Documentation License, Version 1.3
gfdl-1.2 | GNU Free Documentation License, Version 1.2
gfdl-1.1 | GNU Free Documentation License, Version 1.1
mpl-2.0 | This form is subject to the terms of the Mozilla Public License, v. 2.0.
mpl-1.1 | Subject to the Mozilla Public License Version 1.1
mpl-1.0 | Subject to the Mozilla Public License Version 1.0
epl-2.0 | under the terms of the Eclipse Public License v2.0
epl-1.0 | under the terms of the Eclipse Public License v1.0
edl-1.0 | Eclipse Distribution License v1.0
cddl-1.1 | Common Development and Distribution License 1.1
cddl-1.0 | Common Development and Distribution License
eupl-1.2 | European Union Public Licence v. 1.2
eupl-1.1 | European Union Public Licence, version 1.1
eupl | the European Union Public License
unlicense | This is free and unencumbered software released into the public domain.
cc0-1.0 | has waived all copyright and related or neighboring rights
public-domain | We have dedicated to the public domain all of it.
public-domain | This work is in the public domain.
zlib | This software is provided 'as-is', without any express or implied warranty.
bsl-1.0 | Distributed under the Boost Software License, Version 1.0.
wtfpl | Do What The Fuck You Want To Public License
artistic-2.0 | The Artistic License 2.0
artistic-1.0 | Artistic License, version 1.0
perl | You may copy it under the same terms as Perl itself.
ofl-1.1 | Licensed under the SIL Open Font License, Version 1.1.
odbl-1.0 | Open Database License v1.0
odc-by-1.0 | the Open Data Commons Attribution License
pddl-1.0 | Open Data Commons Public Domain Dedication
ogl-uk-3.0 | Open Government Licence v3.0
ogl-uk | Free to use under the Open Government Licence
cc-by-nc-nd | Licensed under CC BY-NC-ND 4.0
cc-by-nc-sa | Licensed under CC BY-NC-SA 4.0
cc-by-nc | Licensed under a CC BY-NC 3.0
cc-by-nd | Licensed under CC BY-ND 2.0
cc-by-sa | Licensed under CC BY-SA 4.0
cc-by | Licensed under CC BY 4.0
cc-by-nc-nd | Creative Commons Attribution-NonCommercial-NoDerivatives 4.0
cc-by-nc-sa | Creative Commons Attribution-NonCommercial-ShareAlike
cc-by-nc | Creative Commons Attribution-NonCommercial 4.0
cc-by-nd | Creative Commons Attribution-NoDerivs 3.0
cc-by-sa | Creative Commons Attribution-ShareAlike 4.0
cc-by | Creative Commons Attribution 4.0 holds
ms-pl | Microsoft Public License
ms-rl | Microsoft Reciprocal License
python-2.0 | Python Software Foundation License
ruby | You may use it under the Ruby License
php-3.01 | Subject to the PHP License
openssl | developed by the OpenSSL Project for use in the OpenSSL Toolkit
ssleay | cryptographic software written by Eric Young
vim | It comes under the Vim license
curl | It comes under the curl license
postgresql | It comes under the PostgreSQL License
w3c | W3C Software Notice and License
unicode | Unicode, Inc. License Agreement
ncsa | University of Illinois/NCSA Open Source License
ecl-2.0 | Educational Community License, Version 2.0
afl-3.0 | Academic Free License v3.0
osl-3.0 | Open Software License v. 3.0
qpl-1.0 | Q Public License
sleepycat | Sleepycat License
watcom | Sybase Open Watcom Public License
ipl-1.0 | IBM Public License
cpl-1.0 | Common Public License
apsl-2.0 | Apple Public Source License
nasa-1.3 | NASA Open Source Agreement
cecill-2.1 | CeCILL Free Software License Agreement v2.1
cecill-b | CeCILL-B holds
cecill-c | CeCILL-C holds
cecill | la licence CeCILL
sspl-1.0 | Server Side Public License
busl-1.1 | Business Source License 1.1
elastic-2.0 | Elastic License 2.0
commons-clause | Commons Clause License Condition
polyform | PolyForm Noncommercial License
rail | a Responsible AI License
rail | CreativeML OpenRAIL-M
rail | shared as RAIL-M
hippocratic | the Hippocratic License
mulan-psl-2.0 | Mulan PSL v2
mulan-psl-1.0 | Mulan PSL v1
upl-1.0 | Universal Permissive License
blueoak-1.0.0 | Blue Oak Model License
fsl | Functional Source License
proprietary | Proprietary and confidential.
proprietary | Unauthorised copying of this file is strictly prohibited
proprietary | It comes under a proprietary license
no-derivatives | No derivative works are allowed
non-commercial | for personal and non-commercial use only
evaluation | licensed for evaluation purposes only
reserved | Copyright 1999 by the owners. All rights reserved.
reserved | Some rights reserved.
reserved-es | Todos los derechos reservados
reserved-fr | Tous droits réservés
reserved-de | Alle Rechte vorbehalten
apache-2.0 | https://www.apache.org/licenses/LICENSE-2.0.txt
apache-1.1 | https://www.apache.org/licenses/LICENSE-1.1
mit | https://opensource.org/licenses/MIT
bsd-3-clause | https://opensource.org/licenses/BSD-3-Clause
bsd-2-clause | https://opensource.org/licenses/BSD-2-Clause
isc | https://opensource.org/licenses/ISC
osi | https://opensource.org/licenses/NPOSL-3.0
gpl-3.0 | https://www.gnu.org/licenses/gpl-3.0.html
gpl-2.0 | https://www.gnu.org/licenses/old-licenses/gpl-2.0.txt
gpl | https://www.gnu.org/licenses/gpl.html
lgpl-2.1 | https://www.gnu.org/licenses/old-licenses/lgpl-2.1.html
lgpl-3.0 | https://www.gnu.org/licenses/lgpl-3.0.html
lgpl | https://www.gnu.org/licenses/lgpl.html
agpl-3.0 | https://www.gnu.org/licenses/agpl-3.0.html
agpl | https://www.gnu.org/licenses/agpl.html
gfdl | https://www.gnu.org/licenses/fdl-1.3.html
mpl-2.0 | https://mozilla.org/MPL/2.0/
mpl-1.1 | https://www.mozilla.org/MPL/MPL-1.1.html
epl-2.0 | https://www.eclipse.org/legal/epl-2.0
epl-1.0 | https://www.eclipse.org/legal/epl-v10.html
bsl-1.0 | https://www.boost.org/LICENSE_1_0.txt
unlicense | https://unlicense.org
wtfpl | http://www.wtfpl.net/about
ofl-1.1 | https://scripts.sil.org/OFL
odbl-1.0 | https://opendatacommons.org/licenses/odbl/1-0
odc-by-1.0 | https://opendatacommons.org/licenses/by/1-0
pddl-1.0 | https://opendatacommons.org/licenses/pddl/1-0
ogl-uk | https://www.nationalarchives.gov.uk/doc/open-government-licence/
cc0-1.0 | https://creativecommons.org/publicdomain/zero/1.0/
cc-pdm-1.0 | https://creativecommons.org/publicdomain/mark/1.0/
cc-by-nc-nd | https://creativecommons.org/licenses/by-nc-nd/4.0/
cc-by-nc-sa | https://creativecommons.org/licenses/by-nc-sa/4.0/
cc-by-nc | https://creativecommons.org/licenses/by-nc/4.0/
cc-by-nd | https://creativecommons.org/licenses/by-nd/4.0/
cc-by-sa | https://creativecommons.org/licenses/by-sa/4.0/
cc-by | https://creativecommons.org/licenses/by/4.0/
sspl-1.0 | https://www.mongodb.com/licensing/server-side-public-license
cecill | http://www.cecill.info
python-2.0 | https://docs.python.org/3/license
blueoak-1.0.0 | https://blueoakcouncil.org/license/1.0.0
apache-2.0 | the Apache 2.0 text
apache | an Apache License of some kind
mit | an MIT licence
expat | the Expat License
bsd-3-clause | the new BSD text
bsd-2-clause | the simplified BSD text
bsd-4-clause | the original BSD text
0bsd | zero-clause BSD
bsd | some BSD license
isc | an ISC licence
agpl-3.0 | the AGPL-3 text
agpl | the AGPL text
lgpl-3.0 | the LGPLv3 text
lgpl-2.1 | the LGPL 2.1 text
lgpl | the LGPL text
lgpl | a Lesser General Public License
agpl | an Affero General Public License
gpl-3.0 | the GPLv3 text
gpl-2.0 | the GPL-2 text
gpl-3.0 | a General Public License version 3
gpl-2.0 | a General Public License version 2
mpl-2.0 | the Mozilla Public License 2.0
mpl | a Mozilla Public License
epl | an Eclipse Public License
bsl-1.0 | a Boost Software License
zlib | the zlib License
ofl | an Open Font License
cc0-1.0 | given as CC0 1.0
cc-by-nc-nd | given as CC-BY-NC-ND
cc-by-nc-sa | given as CC-BY-NC-SA
cc-by-nc | given as CC-BY-NC
cc-by-nd | given as CC-BY-ND
cc-by-sa | given as CC-BY-SA
creative-commons | a Creative Commons license
copyleft | a copyleft text
copyright | Copyright (c) 2019 by its authors
copyright | © 2020 its authors
"""


@pytest.fixture(scope="module")
def scanner():
    return licenses.Scanner()


def test_each_example_has_its_labels(scanner):
    wrong = []
    for line in EXAMPLES.strip().splitlines():
        labels, text = line.split(" | ", 1)
        found = sorted({rule.label for _, _, rule in scanner.scan(text)})
        if found != labels.split(","):
            wrong.append((labels, found, text))
    assert wrong == []


def test_each_written_rule_has_an_example(scanner):
    used = {id(rule) for line in EXAMPLES.strip().splitlines() for _, _, rule in scanner.scan(line.split(" | ", 1)[1])}
    unused = [rule.expression.pattern for rule in scanner.rules if id(rule) not in used and "spdx-license-identifier" not in rule.expression.pattern]
    assert unused == []


def test_each_tag_of_the_list_is_read(scanner):
    for tag in licenses.SPDX.split():
        assert {r.label for _, _, r in scanner.scan(f"# SPDX-License-Identifier: {tag}\n")} == {tag.lower()}
        assert tag.lower() in {r.label for _, _, r in scanner.scan(f'"license": "{tag}",')}
