"""License scans: ordered signature rules behind a keyword prefilter, overlaps resolved by priority and containment."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.llm.common import prepare

# Phrases of the base and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Each license: label, keywords ("|" between them) of which a text must hold one, pattern of its name, and its SPDX identifiers. Names are matched in
# lower-cased text; "~" stands for any run of characters that are not part of words.
LICENSES = (
    ("apache-1.1", "apache", r"apache~(?:software~)?license,?~(?:version~|v\.?~?)?1[.]1", "apache-1.1"),
    ("apache-2.0", "apache", r"apache~(?:software~)?license,?~(?:version~|v\.?~?)?2(?:[.]0)?", "apache-2.0"),
    ("apache-2.0", "apache", r"apache~(?:v\.?)?2(?:[.]0)?(?:~licen[sc]ed?)?", ""),
    ("apache-1.1", "apache", r"apache~(?:v\.?)?1[.]1(?:~licen[sc]ed?)?", ""),
    ("asf", "asf", r"licen[sc]ed~to~the~apache~software~foundation~[(]?asf", ""),
    ("apache", "apache", r"apache~(?:software~)?license", ""),
    ("mit", "mit", r"(?:the~)?mit~(?:x11~)?licen[sc]e", "mit"),
    ("mit", "mit", r"mit~licen[sc]ed|licen[sc]ed~under~mit|mit~x11", ""),
    ("mit-0", "mit", r"mit~no~attribution(?:~license)?|mit~0(?:~license)?", "mit-0"),
    ("x11", "x11", r"x11~license", "x11"),
    ("bsd-4-clause", "bsd", r"(?:4|four)~clause~bsd(?:~license)?|original~bsd~license", "bsd-4-clause"),
    ("bsd-3-clause", "bsd", r"(?:3|three)~clause~bsd(?:~license)?|(?:new|modified|revised)~bsd(?:~license)?", "bsd-3-clause"),
    ("bsd-2-clause", "bsd", r"(?:2|two)~clause~bsd(?:~license)?|simplified~bsd(?:~license)?|freebsd~license", "bsd-2-clause"),
    ("bsd-4-clause", "bsd", r"bsd~(?:4|four)~clause(?:~licen[sc]e)?|bsd~license~with~advertising~clause", ""),
    ("bsd-3-clause", "bsd", r"bsd~(?:3|three)~clause(?:~licen[sc]e)?|bsd~3(?:~licen[sc]e)?|3~bsd~licen[sc]e", ""),
    ("bsd-2-clause", "bsd", r"bsd~(?:2|two)~clause(?:~licen[sc]e)?|bsd~2(?:~licen[sc]e)?|2~bsd~licen[sc]e", ""),
    ("bsd-0-clause", "0bsd|zero", r"0bsd|zero~clause~bsd(?:~license)?", "0bsd"),
    ("bsd", "bsd", r"bsd~(?:style~)?licen[sc]e", ""),
    ("gpl-1.0", "gpl", r"(?:gnu~)?gpl~?(?:version~|v[.]?~?)?1(?:[.]0)?", "gpl-1.0(?:-only|-or-later)?"),
    ("gpl-2.0", "gpl", r"(?:gnu~)?gpl~?(?:version~|v[.]?~?)?2(?:[.]0)?", "gpl-2.0(?:-only|-or-later)?"),
    ("gpl-3.0", "gpl", r"(?:gnu~)?gpl~?(?:version~|v[.]?~?)?3(?:[.]0)?", "gpl-3.0(?:-only|-or-later)?"),
    ("lgpl-2.0", "lesser|library", r"(?:gnu~)?(?:lesser|library)~general~public~license,?~(?:version~|v\.?~?)?2(?:[.]0)?", ""),
    ("lgpl-2.1", "lesser|library", r"(?:gnu~)?(?:lesser|library)~general~public~license,?~(?:version~|v\.?~?)?2[.]1", ""),
    ("lgpl-3.0", "lesser|library", r"(?:gnu~)?(?:lesser|library)~general~public~license,?~(?:version~|v\.?~?)?3(?:[.]0)?", ""),
    ("agpl-1.0", "affero", r"(?:gnu~)?affero~general~public~license,?~(?:version~|v\.?~?)?1(?:[.]0)?", "agpl-1.0(?:-only|-or-later)?"),
    ("agpl-3.0", "affero", r"(?:gnu~)?affero~general~public~license,?~(?:version~|v\.?~?)?3(?:[.]0)?", ""),
    ("lgpl", "lgpl", r"gnu~lgpl|lgpl~licen[sc]ed?|under~(?:the~)?lgpl", ""),
    ("agpl", "agpl", r"gnu~agpl|agpl~licen[sc]ed?|under~(?:the~)?agpl", ""),
    ("gpl", "gpl", r"gnu~gpl|gpl~licen[sc]ed?|under~(?:the~)?gpl|gpl~compatible", ""),
    ("gpl-1.0", "general", r"(?:gnu~)?general~public~license,?~(?:version~|v[.]?~?)?1(?:[.]0)?", ""),
    ("gpl-2.0", "general", r"(?:gnu~)?general~public~license,?~(?:version~|v[.]?~?)?2(?:[.]0)?", ""),
    ("gpl-3.0", "general", r"(?:gnu~)?general~public~license,?~(?:version~|v[.]?~?)?3(?:[.]0)?", ""),
    ("lgpl-2.0", "lgpl", r"(?:gnu~)?lgpl~?(?:version~|v[.]?~?)?2(?:[.]0)?", "lgpl-2.0(?:-only|-or-later)?"),
    ("lgpl-2.1", "lgpl", r"(?:gnu~)?lgpl~?(?:version~|v[.]?~?)?2[.]1", "lgpl-2.1(?:-only|-or-later)?"),
    ("lgpl-3.0", "lgpl", r"(?:gnu~)?lgpl~?(?:version~|v[.]?~?)?3(?:[.]0)?", "lgpl-3.0(?:-only|-or-later)?"),
    ("lgpl", "lesser|library", r"(?:gnu~)?(?:lesser|library)~general~public~license", ""),
    ("agpl-3.0", "agpl", r"(?:gnu~)?agpl~?(?:version~|v[.]?~?)?3(?:[.]0)?", "agpl-3.0(?:-only|-or-later)?"),
    ("agpl", "affero", r"(?:gnu~)?affero~general~public~license", ""),
    ("gfdl", "documentation", r"gnu~free~documentation~license", "gfdl-1.[123](?:-only|-or-later)?"),
    ("gpl", "general", r"(?:gnu~)?general~public~license", ""),
    ("mpl-1.1", "mozilla", r"mozilla~public~license,?~(?:version~|v\.?~?)?1[.]1", "mpl-1.1"),
    ("mpl-2.0", "mozilla", r"mozilla~public~license,?~(?:version~|v\.?~?)?2(?:[.]0)?", "mpl-2.0"),
    ("mpl-1.1", "mpl", r"mpl~?(?:version~|v[.]?~?)?1[.]1", ""),
    ("mpl-2.0", "mpl", r"mpl~?(?:version~|v[.]?~?)?2(?:[.]0)?", ""),
    ("mpl", "mozilla", r"mozilla~public~license", ""),
    ("epl-1.0", "eclipse", r"eclipse~public~license,?~(?:version~|v\.?~?)?1(?:[.]0)?", "epl-1.0"),
    ("epl-2.0", "eclipse", r"eclipse~public~license,?~(?:version~|v\.?~?)?2(?:[.]0)?", "epl-2.0"),
    ("epl-1.0", "epl", r"epl~?(?:version~|v[.]?~?)?1(?:[.]0)?", ""),
    ("epl-2.0", "epl", r"epl~?(?:version~|v[.]?~?)?2(?:[.]0)?", ""),
    ("epl", "eclipse", r"eclipse~public~license", ""),
    ("edl-1.0", "eclipse", r"eclipse~distribution~license", "edl-1.0"),
    ("cddl-1.0", "distribution", r"common~development~and~distribution~license", "cddl-1.0"),
    ("cpl-1.0", "common", r"common~public~license", "cpl-1.0"),
    ("ipl-1.0", "ibm", r"ibm~public~license", "ipl-1.0"),
    ("isc", "isc", r"isc~license", "isc"),
    ("zlib", "zlib", r"zlib(?:~libpng)?~license", "zlib"),
    ("libpng", "libpng", r"libpng~license", "libpng-2.0"),
    ("unlicense", "unlicense", r"(?:the~)?unlicense|released~into~the~public~domain~under~the~unlicense", "unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl", "wtfpl"),
    ("wtfpl", "public", r"do~what~the~fuck~you~want~to~public~license", ""),
    ("bsl-1.0", "boost", r"boost~software~license", "bsl-1.0"),
    ("artistic-1.0", "artistic", r"artistic~license,?~(?:version~)?1(?:[.]0)?", "artistic-1.0"),
    ("artistic-2.0", "artistic", r"artistic~license,?~(?:version~)?2(?:[.]0)?", "artistic-2.0"),
    ("artistic", "artistic", r"(?:perl~)?artistic~license", ""),
    ("psf-2.0", "python|psf", r"(?:psf|python(?:~software~foundation)?)~license(?:~agreement)?", "psf-2.0|python-2.0"),
    ("ruby", "ruby", r"ruby~license", "ruby"),
    ("php-3.01", "php", r"php~license", "php-3.0[1]?"),
    ("openssl", "openssl", r"openssl~license", "openssl"),
    ("curl", "curl", r"curl~license", "curl"),
    ("ncsa", "ncsa|illinois", r"(?:university~of~illinois|ncsa)~(?:open~source~)?license", "ncsa"),
    ("postgresql", "postgresql", r"postgresql~license", "postgresql"),
    ("ofl-1.1", "font", r"(?:sil~)?open~font~license", "ofl-1.[01]"),
    ("eupl-1.2", "european", r"european~union~public~licen[cs]e", "eupl-1.[012]"),
    ("cecill-2.1", "cecill", r"cecill~(?:free~software~)?licen[cs]e", "cecill-2.[01]"),
    ("ms-pl", "microsoft", r"microsoft~public~license", "ms-pl"),
    ("ms-rl", "microsoft", r"microsoft~reciprocal~license", "ms-rl"),
    ("osl-3.0", "open", r"open~software~license", "osl-3.0"),
    ("afl-3.0", "academic", r"academic~free~license", "afl-3.0"),
    ("odbl-1.0", "database", r"open~database~license", "odbl-1.0"),
    ("odc-by", "attribution", r"open~data~commons~attribution~license", "odc-by-1.0"),
    ("pddl-1.0", "dedication", r"(?:odc~)?public~domain~dedication~and~license", "pddl-1.0"),
    ("cc0-1.0", "cc0", r"cc0(?:~1[.]0)?(?:~universal)?", "cc0-1.0"),
    ("cc-by-nc-nd", "noncommercial", r"(?:creative~commons~)?attribution~noncommercial~noderiv(?:ative)?s", "cc-by-nc-nd-[1-4].0"),
    ("cc-by-nc-sa", "noncommercial", r"(?:creative~commons~)?attribution~noncommercial~sharealike", "cc-by-nc-sa-[1-4].0"),
    ("cc-by-nc", "noncommercial", r"(?:creative~commons~)?attribution~noncommercial", "cc-by-nc-[1-4].0"),
    ("cc-by-nd", "noderiv", r"(?:creative~commons~)?attribution~noderiv(?:ative)?s", "cc-by-nd-[1-4].0"),
    ("cc-by-sa", "sharealike", r"(?:creative~commons~)?attribution~sharealike", "cc-by-sa-[1-4].0"),
    ("cc-by-nc-nd", "cc", r"cc~by~nc~nd(?:~[1-4][.][05])?", ""),
    ("cc-by-nc-sa", "cc", r"cc~by~nc~sa(?:~[1-4][.][05])?", ""),
    ("cc-by-sa", "cc", r"cc~by~sa(?:~[1-4][.][05])?", ""),
    ("cc-by-nd", "cc", r"cc~by~nd(?:~[1-4][.][05])?", ""),
    ("cc-by-nc", "cc", r"cc~by~nc(?:~[1-4][.][05])?", ""),
    ("cc-by", "creative", r"creative~commons~attribution(?:~[1-4][.][05])?(?:~international|~unported|~generic)?(?:~licen[sc]e)?", "cc-by-[1-4].0"),
    ("creative-commons", "creative", r"creative~commons~licen[sc]e", ""),
    ("elastic-2.0", "elastic", r"elastic~license", "elastic-2.0"),
    ("sspl-1.0", "sspl|server", r"sspl|server~side~public~license", "sspl-1.0"),
    ("busl-1.1", "business", r"business~source~license", "busl-1.1"),
    ("polyform", "polyform", r"polyform~(?:noncommercial|small~business|strict|shield)~license", "polyform-[a-z-]+-1.0.0"),
    ("openrail", "rail", r"(?:creativeml~)?open~?rail~?[ms]?(?:~license)?", "creativeml-openrail-m"),
    ("llama", "llama", r"llama~[2-4](?:[.][0-9])?~community~license", ""),
    ("gemma", "gemma", r"gemma~terms~of~use", ""),
    ("public-domain", "domain", r"(?:in|into|to)~the~public~domain|public~domain~work", ""),
    ("proprietary", "proprietary", r"proprietary~and~confidential|confidential~and~proprietary", ""),
    ("no-redistribution", "redistribut|reproduction", r"(?:redistribution|reproduction)~(?:is~)?(?:strictly~)?(?:prohibited|forbidden)", ""),
    ("reserved", "rights", r"all~rights~reserved", ""),
    ("reserved", "rechte", r"alle~rechte~vorbehalten", ""),
    ("reserved", "droits", r"tous~droits~réservés", ""),
    ("reserved", "derechos", r"todos~los~derechos~reservados", ""),
    ("permission-text", "permission", r"permission~is~hereby~granted,?~free~of~charge", ""),
    ("bsd-text", "redistribution", r"redistribution~and~use~in~source~and~binary~forms", ""),
    ("warranty-text", "warranty", r"provided~as~is,?~without~warranty~of~any~kind", ""),
)
# Addresses of license texts: label, keyword, pattern after an optional "www.".
ADDRESSES = (
    ("apache-1.1", "apache", r"apache[.]org/licenses/license-1[.]1"),
    ("apache-2.0", "apache", r"apache[.]org/licenses/license-2[.]0"),
    ("gpl-1.0", "gnu.org", r"gnu[.]org/licenses/(?:old-licenses/)?gpl-1[.]0"),
    ("gpl-2.0", "gnu.org", r"gnu[.]org/licenses/(?:old-licenses/)?gpl-2[.]0"),
    ("gpl-3.0", "gnu.org", r"gnu[.]org/licenses/gpl-3[.]0"),
    ("gpl", "gnu.org", r"gnu[.]org/(?:licenses|copyleft)/gpl"),
    ("lgpl-2.0", "gnu.org", r"gnu[.]org/licenses/(?:old-licenses/)?lgpl-2[.]0"),
    ("lgpl-2.1", "gnu.org", r"gnu[.]org/licenses/(?:old-licenses/)?lgpl-2[.]1"),
    ("lgpl-3.0", "gnu.org", r"gnu[.]org/licenses/lgpl-3[.]0"),
    ("lgpl", "gnu.org", r"gnu[.]org/(?:licenses|copyleft)/lgpl"),
    ("agpl-3.0", "gnu.org", r"gnu[.]org/licenses/agpl(?:-3[.]0)?"),
    ("gfdl", "gnu.org", r"gnu[.]org/licenses/fdl"),
    ("mit", "opensource.org", r"opensource[.]org/licen[sc]es?/mit"),
    ("isc", "opensource.org", r"opensource[.]org/licen[sc]es?/isc"),
    ("zlib", "opensource.org", r"opensource[.]org/licen[sc]es?/zlib"),
    ("apache-2.0", "opensource.org", r"opensource[.]org/licen[sc]es?/apache-2[.]0"),
    ("bsd-2-clause", "opensource.org", r"opensource[.]org/licen[sc]es?/bsd-2-clause"),
    ("bsd-3-clause", "opensource.org", r"opensource[.]org/licen[sc]es?/bsd-3-clause"),
    ("bsd", "opensource.org", r"opensource[.]org/licen[sc]es?/bsd-license"),
    ("gpl-2.0", "opensource.org", r"opensource[.]org/licen[sc]es?/gpl-2[.]0"),
    ("gpl-3.0", "opensource.org", r"opensource[.]org/licen[sc]es?/gpl-3[.]0"),
    ("mpl-2.0", "opensource.org", r"opensource[.]org/licen[sc]es?/mpl-2[.]0"),
    ("artistic-2.0", "opensource.org", r"opensource[.]org/licen[sc]es?/artistic-2[.]0"),
    ("mpl-1.1", "mozilla.org", r"mozilla[.]org/mpl/(?:mpl-)?1[.]1"),
    ("mpl-2.0", "mozilla.org", r"mozilla[.]org/(?:en-us/)?mpl/2[.]0"),
    ("mpl", "mozilla.org", r"mozilla[.]org/(?:en-us/)?mpl"),
    ("epl-1.0", "eclipse.org", r"eclipse[.]org/legal/epl-v10"),
    ("epl-2.0", "eclipse.org", r"eclipse[.]org/legal/epl-(?:v20|2[.]0)"),
    ("edl-1.0", "eclipse.org", r"eclipse[.]org/org/documents/edl-v10"),
    ("bsl-1.0", "boost.org", r"boost[.]org/license_1_0"),
    ("unlicense", "unlicense.org", r"unlicense[.]org"),
    ("wtfpl", "wtfpl.net", r"wtfpl[.]net"),
    ("ofl-1.1", "sil.org", r"scripts[.]sil[.]org/ofl"),
    ("cddl-1.0", "cddl", r"(?:opensource[.]org/licen[sc]es?|sun[.]com/cddl)/cddl(?:-1[.]0)?"),
    ("cc0-1.0", "creativecommons", r"creativecommons[.]org/publicdomain/zero/1[.]0"),
    ("public-domain", "creativecommons", r"creativecommons[.]org/(?:publicdomain/mark|licenses/publicdomain)"),
    ("cc-by-nc-nd", "creativecommons", r"creativecommons[.]org/licenses/by-nc-nd/[1-4][.][05]"),
    ("cc-by-nc-sa", "creativecommons", r"creativecommons[.]org/licenses/by-nc-sa/[1-4][.][05]"),
    ("cc-by-nc", "creativecommons", r"creativecommons[.]org/licenses/by-nc/[1-4][.][05]"),
    ("cc-by-nd", "creativecommons", r"creativecommons[.]org/licenses/by-nd/[1-4][.][05]"),
    ("cc-by-sa", "creativecommons", r"creativecommons[.]org/licenses/by-sa/[1-4][.][05]"),
    ("cc-by", "creativecommons", r"creativecommons[.]org/licenses/by/[1-4][.][05]"),
    ("odbl-1.0", "opendatacommons", r"opendatacommons[.]org/licenses/odbl"),
    ("odc-by", "opendatacommons", r"opendatacommons[.]org/licenses/by"),
    ("pddl-1.0", "opendatacommons", r"opendatacommons[.]org/licenses/pddl"),
)
# Sentences of license texts and notices: label, keyword, pattern as for the names.
SENTENCES = (
    ("mit", "permission", r"permission~is~hereby~granted,?~free~of~charge,?~to~any~person~obtaining~a~copy~of~this~software"),
    ("mit", "copyright", r"the~above~copyright~notice~and~this~permission~notice~shall~be~included~in~all~copies~or~substantial~portions"),
    ("mit-0", "permission", r"permission~is~hereby~granted,?~free~of~charge,?~to~any~person~obtaining~a~copy~of~this~software~and~associated~documentation~files~(?:the~software~)?to~deal~in~the~software~without~restriction,?~including~without~limitation~the~rights~to~use,?~copy,?~modify,?~merge,?~publish,?~distribute,?~sublicense,?~and~or~sell~copies~of~the~software,?~and~to~permit~persons~to~whom~the~software~is~furnished~to~do~so[.]~the~software~is~provided"),
    ("isc", "permission", r"permission~to~use,?~copy,?~modify,?~and~(?:or~)?distribute~this~software~for~any~purpose~with~or~without~fee~is~hereby~granted"),
    ("bsd", "redistribution", r"redistribution~and~use~in~source~and~binary~forms,?~with~or~without~modification,?~are~permitted"),
    ("bsd-3-clause", "endorse", r"may~be~used~to~endorse~or~promote~products~derived~from~this~software~without~specific~prior~written~permission"),
    ("bsd-4-clause", "advertising", r"all~advertising~materials~mentioning~features~or~use~of~this~software~must~display~the~following~acknowledge?ment"),
    ("apache-2.0", "apache", r"you~may~not~use~this~file~except~in~compliance~with~the~license[.]~you~may~obtain~a~copy~of~the~license~at~https?~(?:www[.])?apache[.]org"),
    ("apache-2.0", "apache", r"apache~license~version~2[.]0,?~january~2004"),
    ("gpl", "redistribute", r"you~can~redistribute~it~and~or~modify~it~under~the~terms~of~the~gnu~general~public~license"),
    ("lgpl", "redistribute", r"you~can~redistribute~it~and~or~modify~it~under~the~terms~of~the~gnu~(?:lesser|library)~general~public~license"),
    ("agpl", "redistribute", r"you~can~redistribute~it~and~or~modify~it~under~the~terms~of~the~gnu~affero~general~public~license"),
    ("gpl-2.0", "version", r"either~version~2~of~the~license,?~or~(?:[(]?at~your~option[)]?~)?any~later~version"),
    ("gpl-3.0", "version", r"either~version~3~of~the~license,?~or~(?:[(]?at~your~option[)]?~)?any~later~version"),
    ("lgpl-2.1", "version", r"either~version~2[.]1~of~the~license,?~or~(?:[(]?at~your~option[)]?~)?any~later~version"),
    ("gpl", "gnu", r"you~should~have~received~a~copy~of~the~gnu~general~public~license"),
    ("lgpl", "gnu", r"you~should~have~received~a~copy~of~the~gnu~(?:lesser|library)~general~public~license"),
    ("agpl", "gnu", r"you~should~have~received~a~copy~of~the~gnu~affero~general~public~license"),
    ("gpl-2.0", "gnu", r"gnu~general~public~license~version~2,?~june~1991"),
    ("gpl-3.0", "gnu", r"gnu~general~public~license~version~3,?~29~june~2007"),
    ("gfdl", "copy", r"permission~is~granted~to~copy,?~distribute~and~or~modify~this~document~under~the~terms~of~the~gnu~free~documentation~license"),
    ("mpl-2.0", "mozilla", r"this~source~code~form~is~subject~to~the~terms~of~the~mozilla~public~license,?~v[.]?~2[.]0"),
    ("mpl-1.1", "mozilla", r"the~contents~of~this~file~are~subject~to~the~mozilla~public~license~version~1[.]1"),
    ("epl-1.0", "eclipse", r"accompanying~materials~are~made~available~under~the~terms~of~the~eclipse~public~license~v1[.]0"),
    ("epl-2.0", "eclipse", r"accompanying~materials~are~made~available~under~the~terms~of~the~eclipse~public~license~2[.]0"),
    ("cddl-1.0", "development", r"subject~to~the~terms~of~the~common~development~and~distribution~license"),
    ("zlib", "express", r"this~software~is~provided~as~is,?~without~any~express~or~implied~warranty"),
    ("zlib", "misrepresented", r"the~origin~of~this~software~must~not~be~misrepresented"),
    ("unlicense", "unencumbered", r"this~is~free~and~unencumbered~software~released~into~the~public~domain"),
    ("bsl-1.0", "boost", r"distributed~under~the~boost~software~license,?~version~1[.]0"),
    ("artistic", "artistic", r"under~the~(?:same~)?terms~(?:of~(?:either~)?(?:the~)?artistic~license|as~perl~itself~artistic)"),
    ("perl", "perl", r"under~the~same~terms~as~perl~(?:5~)?itself"),
    ("psf-2.0", "python", r"python~software~foundation~license~version~2"),
    ("php-3.01", "php", r"subject~to~version~3[.]01~of~the~php~license"),
    ("openssl", "openssl", r"this~product~includes~software~developed~by~the~openssl~project"),
    ("ofl-1.1", "font", r"this~font~software~is~licensed~under~the~sil~open~font~license,?~version~1[.]1"),
    ("wtfpl", "everyone", r"everyone~is~permitted~to~copy~and~distribute~verbatim~or~modified~copies~of~this~license~document,?~and~changing~it~is~allowed"),
    ("cc0-1.0", "waived", r"has~(?:dedicated~the~work~to~the~public~domain~by~)?waiv(?:ed|ing)~all~(?:of~(?:his|her|their)~)?(?:copyright~and~related~or~neighbou?ring~)?rights~to~(?:the|this)~work"),
    ("cc-by", "creative", r"licen[sc]ed~under~a~creative~commons~attribution~(?:[1-4][.][05]~)?(?:international~|unported~|generic~)?licen[sc]e"),
    ("cc-by-sa", "creative", r"licen[sc]ed~under~a~creative~commons~attribution~share~?alike~(?:[1-4][.][05]~)?(?:international~|unported~|generic~)?licen[sc]e"),
    ("public-domain", "domain", r"(?:dedicated|placed|released)~(?:in|into|to)~the~public~domain", ),
    ("proprietary", "unauthorized", r"unauthorized~copying~of~this~file,?~via~any~medium,?~is~strictly~prohibited"),
    ("proprietary", "trade", r"contains~(?:proprietary~and~confidential~information|trade~secrets)"),
    ("no-redistribution", "permission", r"may~not~be~(?:copied|reproduced|redistributed|republished)~(?:or~[a-z]+~)?without~(?:the~)?(?:prior~)?(?:written~)?permission"),
    ("non-commercial", "commercial", r"(?:for~)?non~?commercial~(?:use|purposes)~only"),
    ("research-only", "research", r"for~(?:academic~)?research~(?:use|purposes)~only"),
)
# License expressions: an identifier that OR, AND or a slash joins to another one; each half is a detection of its own.
EXPRESSION_IDS = (
    ("mit", "mit"), ("apache-2.0", r"apache~?2(?:[.]0)?"), ("gpl-2.0", r"gpl~?v?2(?:[.]0)?(?:~only|~or~later)?[+]?"), ("gpl-3.0", r"gpl~?v?3(?:[.]0)?(?:~only|~or~later)?[+]?"), ("lgpl-2.1", r"lgpl~?v?2[.]1(?:~only|~or~later)?[+]?"),
    ("lgpl-3.0", r"lgpl~?v?3(?:[.]0)?(?:~only|~or~later)?[+]?"), ("mpl-2.0", r"mpl~?2(?:[.]0)?"), ("epl-2.0", r"epl~?2(?:[.]0)?"), ("bsd-2-clause", r"bsd~2~clause"), ("bsd-3-clause", r"bsd~3~clause"), ("isc", "isc"), ("zlib", "zlib"), ("bsl-1.0", r"bsl~1[.]0"), ("cc0-1.0", r"cc0(?:~1[.]0)?"), ("unlicense", "unlicense"),
)
#: Kinds of rules, first the most telling, with their weights; a name or an address after GRANT weighs as much as a sentence.
WEIGHTS = {"sentence": 1.0, "spdx": 1.0, "address": 0.9, "expression": 0.8, "name": 0.6}
GRANT = re.compile(rb"(?:(?:licen[sc]ed|released|distributed|available|published|provided|subject|covered|governed)[\x00-\x2f\x3a-\x60\x7b-\x7f]+(?:to|by|under|with|at)|under|licen[sc]e:)(?:[\x00-\x2f\x3a-\x60\x7b-\x7f]+(?:the|terms|of|and|conditions|an?))*[\x00-\x2f\x3a-\x60\x7b-\x7f]*(?:https?://(?:www[.])?)?\Z")
#: Bytes before a match in which GRANT may stand.
BEFORE = 120
OWN, GAP = r"0-9a-z\x80-\xff", r"(?:[\x00-\x2f\x3a-\x60\x7b-\x7f]++)"
WORD_BYTES = np.zeros(256, bool)
WORD_BYTES[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


@dataclass(frozen=True)
class Rule:
    """``priority`` orders the rules: of detections that cross, a smaller one wins. One of ``keywords`` gates the pattern."""

    label: str
    kind: str
    keywords: tuple[bytes, ...]
    pattern: re.Pattern[bytes]
    priority: int


@lru_cache(1)
def rules() -> tuple[Rule, ...]:
    """The rules in order: sentences, SPDX tags, addresses, expressions, then names, specific licenses before general ones."""
    out: list[Rule] = []

    def add(label: str, kind: str, keyword: str, pattern: str) -> None:
        # a match ends before anything but a word; "2" is no beginning of "2.1"
        body = f"(?<![{OWN}])(?:{pattern.replace('~', GAP)})(?![{OWN}])" + ("" if kind == "address" else r"(?![.][0-9])")
        out.append(Rule(label, kind, tuple(keyword.encode().split(b"|")), re.compile(body.encode()), len(out)))

    for label, keyword, pattern in SENTENCES:
        add(label, "sentence", keyword, pattern)
    for label, _, _, tag in LICENSES:
        if tag:
            add(label, "spdx", "spdx", r"spdx-license-identifier:[^\n]*?(?<![-0-9a-z.])(" + tag.replace(".", "[.]").replace("[[.]", "[.").replace("[.]]", ".]") + ")(?!-)")
    for label, keyword, pattern in ADDRESSES:
        add(label, "address", keyword, pattern)
    other, joint = "|".join(p for _, p in EXPRESSION_IDS), r"(?:~(?:or|and)~|[\x20]?/[\x20]?)"
    for label, name in EXPRESSION_IDS:
        keyword = next(k for k in ("mit", "apache", "lgpl", "gpl", "mpl", "epl", "bsd", "isc", "zlib", "bsl", "cc0", "unlicense") if k in name)
        add(label, "expression", keyword, f"({name})(?={joint}(?:{other})(?![{OWN}]))")
        add(label, "expression", keyword, f"(?:{other}){joint}({name})")
    for label, keyword, name, _ in LICENSES:
        add(label, "name", keyword, name)
    return tuple(out)


@lru_cache(1)
def _gates() -> dict[tuple[bytes, ...], list[Rule]]:
    by: dict[tuple[bytes, ...], list[Rule]] = {}
    for rule in rules():
        by.setdefault(rule.keywords, []).append(rule)
    return by


_PHRASES = tuple((re.compile(f"(?<![{OWN}])".encode("latin-1") + r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+".encode("latin-1").join(w.encode() for w in p.split()) + f"(?![{OWN}])".encode("latin-1")), p.split()[-1].encode(), label) for p, label in PHRASES)


def suppressed(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """``found`` (start, end, rule) without overlaps, by start, in n log n.

    A detection that another one contains goes, whatever their rules; of equal intervals and of two that cross the rule
    of higher priority (a smaller number) wins, then the earlier start. What a suppressed one would have crossed stays.
    """
    outer: list[tuple[int, int, Rule]] = []
    reach = -1
    for s, e, rule in sorted(found, key=lambda x: (x[0], -x[1], x[2].priority)):
        if e > reach:
            outer.append((s, e, rule))
            reach = e
    # no one contains another now, so starts and ends are in one order and a neighbour is all that can cross
    kept = [False] * len(outer)
    before, after = list(range(-1, len(outer) - 1)), list(range(1, len(outer) + 1))
    gone = [False] * len(outer)
    for i in sorted(range(len(outer)), key=lambda i: (outer[i][2].priority, outer[i][0])):
        if gone[i]:
            continue
        kept[i] = True
        j = before[i]
        while j >= 0 and not kept[j] and outer[j][1] > outer[i][0]:
            gone[j], j = True, before[j]
        before[i] = j
        if j >= 0:
            after[j] = i
        j = after[i]
        while j < len(outer) and not kept[j] and outer[j][0] < outer[i][1]:
            gone[j], j = True, after[j]
        after[i] = j
        if j < len(outer):
            before[j] = i
    return [d for d, stays in zip(outer, kept, strict=True) if stays]


def detections(raw: bytes) -> list[tuple[int, int, Rule]]:
    """(start, end, rule) in lower-cased bytes, by start, overlaps suppressed. Rules run only if one of their keywords occurs;
    of an SPDX line and of an
    expression each identifier is a detection of its own."""
    found = [(*m.span(1 if rule.kind in ("spdx", "expression") else 0), rule) for keys, own in _gates().items() if any(k in raw for k in keys) for rule in own for m in rule.pattern.finditer(raw)]
    return suppressed(found)


def scan_text(text: str | None) -> tuple[int, int, int | None, int | None, str, str, float]:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score) of one whole text; null is empty.

    score is 1 minus the product of (1 - weight) over the labels' best detections: the strength of the evidence that
    the text states a license.
    """
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    inside = WORD_BYTES[np.frombuffer(raw, np.uint8)]
    starts = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]])) if len(raw) else np.zeros(0, np.int64)
    places, base = [], set()
    for pattern, last, label in _PHRASES:
        if last in raw:
            for m in pattern.finditer(raw):
                places.append(int(np.searchsorted(starts, m.start())))
                base.add(label)
    best = {label: 0.6 for label in base}
    for start, _, rule in detections(raw):
        weight = WEIGHTS[rule.kind]
        if weight < 1 and GRANT.search(raw, max(0, start - BEFORE), start):
            weight = 1.0
        best[rule.label] = max(best.get(rule.label, 0), weight)
    score = 1 - float(np.prod([1 - w for w in best.values()])) if best else 0.0
    first, last = (min(places), max(places)) if places else (None, None)
    return len(starts), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(best)), min(1.0, max(0.0, score))


def license_scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) for each row of ``docs``.

    Null texts are empty texts; repeated rows each come back; an empty table gives an empty result; other columns are
    not looked at.
    """
    prepare(docs.sparkSession)
    kinds = {"n_words": "long", "n_base": "long", "first_word": "long", "last_word": "long", "base_labels": "string", "labels": "string", "score": "double"}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = pd.DataFrame([scan_text(t) for t in batch["text"]], columns=list(kinds))
            out = out.astype({"first_word": "Int64", "last_word": "Int64"})
            yield pd.concat([batch[["doc_id"]].reset_index(drop=True), out], axis=1)

    rows = docs.select("doc_id", "text")
    return rows.mapInPandas(run, rows.drop("text").withColumns({k: F.lit(None).cast(v) for k, v in kinds.items()}).schema)
