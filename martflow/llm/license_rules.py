"""Signatures of licences: label, priority (smaller wins), keyword, regular expression.

The keyword is a plain lower-case substring that every match of the regex contains; the regex is only
tried on texts that contain it. Texts are lower-cased (A-Z) first. ``_`` stands for a gap of white
space and comment marks between words.
"""

from __future__ import annotations

from dataclasses import dataclass

#: Priorities: 1 an identifier tag, 2 a grant or a text of the licence itself, 3 a name, 4 a hint.
TAG, TEXT, NAME, HINT = 1, 2, 3, 4


@dataclass(frozen=True)
class Signature:
    label: str
    priority: int
    keyword: str
    pattern: str


def _gap(pattern: str) -> str:
    return pattern.replace("_", r"[\s*#/;,\-]+")


# One line for each licence: SPDX identifier, its label, keyword and expression of its name. Each gives
# three signatures: the SPDX tag, a grant ("licensed under the ..."), and the bare name.
_NAMED: tuple[tuple[str, str, str, str], ...] = (
    ("MIT", "mit", "mit", r"(?:the_)?(?:mit|expat)_licen[sc]e"),
    ("MIT-0", "mit-0", "mit", r"mit_no_attribution"),
    ("Apache-2.0", "apache-2", "apache", r"(?:the_)?apache(?:_software)?_licen[sc]e_(?:version_|v\.?\s?)2(?:\.0)?"),
    ("Apache-1.1", "apache-1.1", "apache", r"apache(?:_software)?_licen[sc]e_(?:version_|v\.?\s?)1\.1"),
    ("Apache-1.0", "apache-1.0", "apache", r"apache(?:_software)?_licen[sc]e_(?:version_|v\.?\s?)1\.0"),
    ("GPL-3.0-or-later", "gpl-3-plus", "gnu general", r"gnu_general_public_licen[sc]e_(?:version_|v\.?\s?)3(?:\.0)?_or_(?:any_)?later"),
    ("GPL-3.0-only", "gpl-3", "gnu general", r"gnu_general_public_licen[sc]e_(?:version_|v\.?\s?)3(?:\.0)?"),
    ("GPL-2.0-or-later", "gpl-2-plus", "gnu general", r"gnu_general_public_licen[sc]e_(?:version_|v\.?\s?)2(?:\.0)?_or_(?:any_)?later"),
    ("GPL-2.0-only", "gpl-2", "gnu general", r"gnu_general_public_licen[sc]e_(?:version_|v\.?\s?)2(?:\.0)?"),
    ("GPL-1.0-only", "gpl-1", "gnu general", r"gnu_general_public_licen[sc]e_(?:version_|v\.?\s?)1(?:\.0)?"),
    ("LGPL-3.0-or-later", "lgpl-3", "lesser", r"gnu_lesser_general_public_licen[sc]e_(?:version_|v\.?\s?)3(?:\.0)?"),
    ("LGPL-2.1-or-later", "lgpl-2.1", "lesser", r"gnu_lesser_general_public_licen[sc]e_(?:version_|v\.?\s?)2\.1"),
    ("LGPL-2.0-or-later", "lgpl-2", "library general", r"gnu_library_general_public_licen[sc]e_(?:version_|v\.?\s?)2(?:\.0)?"),
    ("AGPL-3.0-or-later", "agpl-3", "affero", r"gnu_affero_general_public_licen[sc]e_(?:version_|v\.?\s?)3(?:\.0)?"),
    ("AGPL-1.0", "agpl-1", "affero", r"affero_general_public_licen[sc]e_(?:version_|v\.?\s?)1(?:\.0)?"),
    ("GFDL-1.3", "gfdl-1.3", "documentation", r"gnu_free_documentation_licen[sc]e_(?:version_|v\.?\s?)1\.3"),
    ("GFDL-1.2", "gfdl-1.2", "documentation", r"gnu_free_documentation_licen[sc]e_(?:version_|v\.?\s?)1\.2"),
    ("BSD-2-Clause", "bsd-2", "bsd", r"(?:bsd_2_clause|simplified_bsd|2_clause_bsd|freebsd)(?:_licen[sc]e)?"),
    ("BSD-3-Clause", "bsd-3", "bsd", r"(?:bsd_3_clause|new_bsd|modified_bsd|3_clause_bsd|revised_bsd)(?:_licen[sc]e)?"),
    ("BSD-4-Clause", "bsd-4", "bsd", r"(?:bsd_4_clause|original_bsd|4_clause_bsd)(?:_licen[sc]e)?"),
    ("0BSD", "0bsd", "bsd", r"(?:zero_clause_bsd|0bsd|bsd_zero_clause)(?:_licen[sc]e)?"),
    ("MPL-2.0", "mpl-2", "mozilla", r"mozilla_public_licen[sc]e_(?:version_|v\.?\s?)2(?:\.0)?"),
    ("MPL-1.1", "mpl-1.1", "mozilla", r"mozilla_public_licen[sc]e_(?:version_|v\.?\s?)1\.1"),
    ("EPL-2.0", "epl-2", "eclipse", r"eclipse_public_licen[sc]e(?:_|_version_|_v\.?\s?)2(?:\.0)?"),
    ("EPL-1.0", "epl-1", "eclipse", r"eclipse_public_licen[sc]e(?:_|_version_|_v\.?\s?)1(?:\.0)?"),
    ("CDDL-1.1", "cddl-1.1", "common development", r"common_development_and_distribution_licen[sc]e_(?:version_|v\.?\s?)?1\.1"),
    ("CDDL-1.0", "cddl-1", "common development", r"common_development_and_distribution_licen[sc]e_(?:version_|v\.?\s?)?1\.0"),
    ("CPL-1.0", "cpl-1", "common public", r"common_public_licen[sc]e_(?:version_|v\.?\s?)?1\.0"),
    ("CPAL-1.0", "cpal-1", "common public", r"common_public_attribution_licen[sc]e"),
    ("IPL-1.0", "ipl-1", "ibm", r"ibm_public_licen[sc]e"),
    ("EUPL-1.2", "eupl-1.2", "european union", r"european_union_public_licen[sc]e_(?:version_|v\.?\s?)1\.2"),
    ("EUPL-1.1", "eupl-1.1", "european union", r"european_union_public_licen[sc]e_(?:version_|v\.?\s?)1\.1"),
    ("CECILL-2.1", "cecill-2.1", "cecill", r"cecill(?:_free_software)?(?:_licen[sc]e)?_(?:agreement_)?(?:version_|v\.?\s?)?2\.1"),
    ("CECILL-B", "cecill-b", "cecill", r"cecill_b(?:_licen[sc]e)?"),
    ("CECILL-C", "cecill-c", "cecill", r"cecill_c(?:_licen[sc]e)?"),
    ("Artistic-2.0", "artistic-2", "artistic", r"artistic_licen[sc]e_(?:version_|v\.?\s?)?2(?:\.0)?"),
    ("Artistic-1.0", "artistic-1", "artistic", r"artistic_licen[sc]e_(?:version_|v\.?\s?)?1(?:\.0)?"),
    ("BSL-1.0", "boost-1", "boost", r"boost_software_licen[sc]e"),
    ("ISC", "isc", "isc", r"\bisc_licen[sc]e"),
    ("Zlib", "zlib", "zlib", r"zlib(?:_libpng)?_licen[sc]e"),
    ("libpng-2.0", "libpng-2", "libpng", r"libpng_licen[sc]e"),
    ("Unlicense", "unlicense", "unlicense", r"\bthe_unlicense\b"),
    ("WTFPL", "wtfpl", "want to", r"do_what_the_f\w{3}_you_want_to_public_licen[sc]e"),
    ("CC0-1.0", "cc0", "cc0", r"(?:creative_commons_)?cc0(?:_1\.0)?(?:_universal)?"),
    ("CC-BY-4.0", "cc-by-4", "creative commons", r"creative_commons_attribution_4\.0(?:_international)?"),
    ("CC-BY-3.0", "cc-by-3", "creative commons", r"creative_commons_attribution_3\.0(?:_unported)?"),
    ("CC-BY-SA-4.0", "cc-by-sa-4", "creative commons", r"creative_commons_attribution_share\s?-?alike_4\.0"),
    ("CC-BY-SA-3.0", "cc-by-sa-3", "creative commons", r"creative_commons_attribution_share\s?-?alike_3\.0"),
    ("CC-BY-ND-4.0", "cc-by-nd-4", "creative commons", r"creative_commons_attribution_no\s?-?derivatives_4\.0"),
    ("CC-BY-NC-4.0", "cc-by-nc-4", "creative commons", r"creative_commons_attribution_non\s?-?commercial_4\.0"),
    ("CC-BY-NC-SA-4.0", "cc-by-nc-sa-4", "creative commons", r"creative_commons_attribution_non\s?-?commercial_share\s?-?alike_4\.0"),
    ("CC-BY-NC-ND-4.0", "cc-by-nc-nd-4", "creative commons", r"creative_commons_attribution_non\s?-?commercial_no\s?-?derivatives_4\.0"),
    ("ODbL-1.0", "odbl-1", "open database", r"open_(?:data_commons_open_)?database_licen[sc]e"),
    ("ODC-By-1.0", "odc-by-1", "open data commons", r"open_data_commons_attribution_licen[sc]e"),
    ("PDDL-1.0", "pddl-1", "public domain dedication", r"open_data_commons_public_domain_dedication"),
    ("OGL-UK-3.0", "ogl-3", "open government", r"open_government_licen[sc]e(?:_v3(?:\.0)?)?"),
    ("OFL-1.1", "ofl-1.1", "open font", r"(?:sil_)?open_font_licen[sc]e(?:_version_1\.1)?"),
    ("OSL-3.0", "osl-3", "open software", r"open_software_licen[sc]e_(?:version_|v\.?\s?)?3(?:\.0)?"),
    ("AFL-3.0", "afl-3", "academic free", r"academic_free_licen[sc]e_(?:version_|v\.?\s?)?3(?:\.0)?"),
    ("NPOSL-3.0", "nposl-3", "non-profit", r"non_profit_open_software_licen[sc]e"),
    ("PostgreSQL", "postgresql", "postgresql", r"postgresql_licen[sc]e"),
    ("Python-2.0", "python-2", "python", r"python_software_foundation_licen[sc]e"),
    ("PHP-3.01", "php-3", "php", r"\bphp_licen[sc]e"),
    ("Ruby", "ruby", "ruby", r"\bruby_licen[sc]e"),
    ("Vim", "vim", "vim", r"\bvim_licen[sc]e"),
    ("curl", "curl", "curl", r"\bcurl_licen[sc]e"),
    ("OpenSSL", "openssl", "openssl", r"openssl_licen[sc]e"),
    ("W3C", "w3c", "w3c", r"w3c_software_(?:notice_and_)?licen[sc]e"),
    ("Unicode-DFS-2016", "unicode", "unicode", r"unicode_licen[sc]e_agreement"),
    ("NCSA", "ncsa", "ncsa", r"(?:university_of_illinois_)?ncsa(?:_open_source)?_licen[sc]e"),
    ("MS-PL", "ms-pl", "microsoft", r"microsoft_public_licen[sc]e"),
    ("MS-RL", "ms-rl", "microsoft", r"microsoft_reciprocal_licen[sc]e"),
    ("SSPL-1.0", "sspl-1", "server side", r"server_side_public_licen[sc]e"),
    ("BUSL-1.1", "busl-1.1", "business source", r"business_source_licen[sc]e"),
    ("Elastic-2.0", "elastic-2", "elastic", r"elastic_licen[sc]e_(?:version_|v)?2(?:\.0)?"),
    ("UPL-1.0", "upl-1", "universal permissive", r"universal_permissive_licen[sc]e"),
    ("MulanPSL-2.0", "mulan-2", "mulan", r"mulan_(?:psl|permissive_software_licen[sc]e)_?(?:v2)?"),
    ("LPPL-1.3c", "lppl-1.3", "latex", r"latex_project_public_licen[sc]e"),
    ("QPL-1.0", "qpl-1", "q public", r"\bq_public_licen[sc]e"),
    ("SISSL", "sissl", "sun industry", r"sun_industry_standards_source_licen[sc]e"),
    ("OpenRAIL-M", "openrail", "rail", r"open_?rail(?:_\+?\+?m)?(?:_licen[sc]e)?"),
)

# Wordings of licence texts, grants without a version, tags and hints.
_PHRASES: tuple[tuple[str, int, str, str], ...] = (
    ("mit", TEXT, "permission is hereby granted", r"permission_is_hereby_granted_free_of_charge_to_any_person_obtaining_a_copy"),
    ("mit", TEXT, "above copyright notice and this permission notice", r"the_above_copyright_notice_and_this_permission_notice_shall_be_included"),
    ("mit", TEXT, "under the mit license", r"under_the_mit_license(?![a-z0-9])"),
    ("isc", TEXT, "to use, copy, modify", r"permission_to_use_copy_modify_and_or_distribute_this_software"),
    ("bsd-3", TEXT, "neither the name", r"neither_the_name_of_.{1,80}?_nor_the_names_of_its_contributors"),
    ("bsd-2", TEXT, "redistribution and use", r"redistribution_and_use_in_source_and_binary_forms_with_or_without_modification"),
    ("bsd-4", TEXT, "all advertising materials", r"all_advertising_materials_mentioning_features_or_use_of_this_software"),
    ("apache-2", TEXT, "apache license", r"apache_license_version_2(?![a-z0-9])"),
    ("apache-2", TEXT, "apache.org/licenses/license-2.0", r"apache\.org/licenses/license-2\.0"),
    ("gpl-3-plus", TEXT, "either version 3", r"either_version_3_of_the_license_or_(?:\(at_your_option\)_?)?any_later_version"),
    ("gpl-2-plus", TEXT, "either version 2", r"either_version_2_of_the_license_or_(?:\(at_your_option\)_?)?any_later_version"),
    ("lgpl-2.1", TEXT, "either version 2.1", r"either_version_2\.1_of_the_license_or"),
    ("gpl", TEXT, "gnu.org/licenses/gpl", r"gnu\.org/licenses/gpl"),
    ("lgpl", TEXT, "gnu.org/licenses/lgpl", r"gnu\.org/licenses/lgpl"),
    ("agpl", TEXT, "gnu.org/licenses/agpl", r"gnu\.org/licenses/agpl"),
    ("gpl", NAME, "gnu general public", r"gnu_general_public_licen[sc]e"),
    ("lgpl", NAME, "lesser general public", r"lesser_general_public_licen[sc]e"),
    ("agpl", NAME, "affero general public", r"affero_general_public_licen[sc]e"),
    ("gfdl", NAME, "free documentation", r"free_documentation_licen[sc]e"),
    ("gpl", NAME, "gpl", r"(?<![a-z])gpl(?:_?v?[123](?:\.0)?)?\b(?![\w-])"),
    ("lgpl", NAME, "lgpl", r"\blgpl(?:_?v?[23](?:\.[01])?)?\b"),
    ("agpl", NAME, "agpl", r"\bagpl(?:_?v?3(?:\.0)?)?\b"),
    ("bsd", NAME, "bsd", r"\bbsd_licen[sc]e"),
    ("bsd", NAME, "bsd", r"\bbsd_style_licen[sc]e"),
    ("apache", NAME, "apache", r"\bapache_(?:software_)?licen[sc]e"),
    ("mpl", NAME, "mozilla public", r"mozilla_public_licen[sc]e"),
    ("mpl-2", TEXT, "mozilla.org/mpl/2.0", r"mozilla\.org/mpl/2\.0"),
    ("epl", NAME, "eclipse public", r"eclipse_public_licen[sc]e"),
    ("eupl", NAME, "european union public", r"european_union_public_licen[sc]e"),
    ("artistic", NAME, "artistic", r"artistic_licen[sc]e"),
    ("cddl", NAME, "cddl", r"\bcddl\b"),
    ("boost-1", TEXT, "boost.org/license", r"boost\.org/license_1_0"),
    ("unlicense", TEXT, "free and unencumbered", r"free_and_unencumbered_software_released_into_the_public_domain"),
    ("unlicense", TEXT, "unlicense.org", r"unlicense\.org"),
    ("zlib", TEXT, "as-is", r"this_software_is_provided_'?as_is'?_without_any_express_or_implied_warranty"),
    ("wtfpl", NAME, "wtfpl", r"\bwtfpl\b"),
    ("cc-by-nc", TEXT, "cc", r"(?<![a-z0-9])cc_by_nc(?![a-z0-9])"),
    ("cc-by-nc-sa", TEXT, "cc", r"(?<![a-z0-9])cc_by_nc_sa(?:_[1-4]\.0)?"),
    ("cc-by-nc-nd", TEXT, "cc", r"(?<![a-z0-9])cc_by_nc_nd(?:_[1-4]\.0)?"),
    ("cc-by-sa", TEXT, "cc", r"(?<![a-z0-9])cc_by_sa(?:_[1-4]\.0)?"),
    ("cc-by-nd", TEXT, "cc", r"(?<![a-z0-9])cc_by_nd(?:_[1-4]\.0)?"),
    ("cc-by", TEXT, "cc", r"(?<![a-z0-9])cc_by(?:_[1-4]\.0)?(?![a-z0-9])"),
    ("cc-by", TEXT, "creativecommons.org", r"creativecommons\.org/licenses/by/[1-4]\.0"),
    ("cc-by-sa", TEXT, "creativecommons.org", r"creativecommons\.org/licenses/by-sa/[1-4]\.0"),
    ("cc-by-nc", TEXT, "creativecommons.org", r"creativecommons\.org/licenses/by-nc/[1-4]\.0"),
    ("cc-by-nd", TEXT, "creativecommons.org", r"creativecommons\.org/licenses/by-nd/[1-4]\.0"),
    ("cc-by-nc-sa", TEXT, "creativecommons.org", r"creativecommons\.org/licenses/by-nc-sa/[1-4]\.0"),
    ("cc-by-nc-nd", TEXT, "creativecommons.org", r"creativecommons\.org/licenses/by-nc-nd/[1-4]\.0"),
    ("cc0", TEXT, "creativecommons.org", r"creativecommons\.org/publicdomain/zero"),
    ("public-domain", TEXT, "creativecommons.org", r"creativecommons\.org/publicdomain/mark"),
    ("cc-by", NAME, "creative commons", r"creative_commons_attribution(?:_licen[sc]e)?"),
    ("cc-by-sa", NAME, "creative commons", r"creative_commons_attribution_share\s?-?alike"),
    ("cc-by-nc", NAME, "creative commons", r"creative_commons_(?:attribution_)?non\s?-?commercial"),
    ("cc-by-nd", NAME, "creative commons", r"creative_commons_(?:attribution_)?no\s?-?deriv\w*"),
    ("creative-commons", HINT, "creative commons", r"creative_commons"),
    ("cc-by", NAME, "licencia creative", r"licencia_creative_commons_(?:de_)?(?:atribuci[oó]n|reconocimiento)"),
    ("cc-by", NAME, "licence creative", r"licence_creative_commons_(?:paternit[eé]|attribution)"),
    ("cc-by", NAME, "namensnennung", r"creative_commons_namensnennung"),
    ("public-domain", TEXT, "public domain", r"(?:released|placed|dedicated)_(?:in)?to_the_public_domain"),
    ("public-domain", NAME, "public domain", r"(?:is_)?in_the_public_domain"),
    ("all-rights-reserved", TEXT, "all rights reserved", r"all_rights_reserved"),
    ("all-rights-reserved", TEXT, "derechos reservados", r"todos_los_derechos_reservados"),
    ("all-rights-reserved", TEXT, "droits", r"tous_droits_r[eé]serv[eé]s"),
    ("all-rights-reserved", TEXT, "alle rechte", r"alle_rechte_vorbehalten"),
    ("proprietary", TEXT, "proprietary", r"proprietary_and_confidential"),
    ("proprietary", TEXT, "prohibited", r"unauthori[sz]ed_copying_.{1,60}?_is_strictly_prohibited"),
    ("proprietary", TEXT, "end user", r"end_user_licen[sc]e_agreement"),
    ("copyright", HINT, "copyright", r"copyright_(?:\(c\)_?|©_?)?(?:19|20)\d\d"),
    ("copyright", HINT, "©", r"©\s*(?:19|20)\d\d"),
    ("unknown-license", HINT, "license", r"licensed_under_(?:the_)?\w+"),
)


def signatures() -> list[Signature]:
    """All signatures in the order of the tables."""
    rules = []
    for spdx, label, keyword, name in _NAMED:
        tag = spdx.lower()
        rules.append(Signature(label, TAG, "spdx-license-identifier", r"spdx-license-identifier:\s*" + tag.replace(".", r"\.").replace("+", r"\+") + r"(?![\w.-])"))
        rules.append(Signature(label, TEXT, keyword, r"licen[sc]ed_under_(?:the_terms_of_)?(?:the_)?" + name))
        rules.append(Signature(label, NAME, keyword, name))
    rules += [Signature(*phrase) for phrase in _PHRASES]
    # the tag keeps its own hyphens; everywhere else _ is a gap
    return [r if r.priority == TAG else Signature(r.label, r.priority, r.keyword, _gap(r.pattern)) for r in rules]
