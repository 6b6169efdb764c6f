"""Families of codes and the columns that use them.

Families that are whole judge every code; of the others a code that isn't found is not
known to be wrong, until its published list is loaded (`load_folder`, `load_list`).
"""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _codes(text: str) -> dict[str, str]:
    """`CODE Name` entries, one after the other, with a semicolon between them."""
    return {c: n for c, _, n in (part.strip().partition(" ") for part in text.replace("\n", " ").split(";") if part.strip())}


# Public CAMEO country codes of states, and of regions.
_STATES = """
AFG Afghanistan; ALB Albania; DZA Algeria; AND Andorra; AGO Angola; ATG Antigua and Barbuda; ARG Argentina; ARM Armenia; AUS Australia;
AUT Austria; AZE Azerbaijan; BHS Bahamas; BHR Bahrain; BGD Bangladesh; BRB Barbados; BLR Belarus; BEL Belgium; BLZ Belize; BEN Benin;
BTN Bhutan; BOL Bolivia; BIH Bosnia and Herzegovina; BWA Botswana; BRA Brazil; BRN Brunei; BGR Bulgaria; BFA Burkina Faso; BDI Burundi;
KHM Cambodia; CMR Cameroon; CAN Canada; CPV Cape Verde; CAF Central African Republic; TCD Chad; CHL Chile; CHN China; COL Colombia;
COM Comoros; COD Democratic Republic of the Congo; COG People's Republic of the Congo; CRI Costa Rica; CIV Ivory Coast; HRV Croatia;
CUB Cuba; CYP Cyprus; CZE Czech Republic; DNK Denmark; DJI Djibouti; DMA Dominica; DOM Dominican Republic; TMP East Timor; ECU Ecuador;
EGY Egypt; SLV El Salvador; GNQ Equatorial Guinea; ERI Eritrea; EST Estonia; ETH Ethiopia; FJI Fiji; FIN Finland; FRA France; GAB Gabon;
GMB Gambia; GEO Georgia; DEU Germany; GHA Ghana; GRC Greece; GRD Grenada; GTM Guatemala; GIN Guinea; GNB Guinea-Bissau; GUY Guyana;
HTI Haiti; VAT Vatican City; HND Honduras; HKG Hong Kong; HUN Hungary; ISL Iceland; IND India; IDN Indonesia; IRN Iran; IRQ Iraq;
IRL Ireland; ISR Israel; ITA Italy; JAM Jamaica; JPN Japan; JOR Jordan; KAZ Kazakhstan; KEN Kenya; KIR Kiribati; PRK North Korea;
KOR South Korea; KWT Kuwait; KGZ Kyrgyzstan; LAO Laos; LVA Latvia; LBN Lebanon; LSO Lesotho; LBR Liberia; LBY Libya; LIE Liechtenstein;
LTU Lithuania; LUX Luxembourg; MAC Macao; MKD Macedonia; MDG Madagascar; MWI Malawi; MYS Malaysia; MDV Maldives; MLI Mali; MLT Malta;
MHL Marshall Islands; MRT Mauritania; MUS Mauritius; MEX Mexico; FSM Micronesia; MDA Moldova; MCO Monaco; MNG Mongolia; MTN Montenegro;
MAR Morocco; MOZ Mozambique; MMR Myanmar; NAM Namibia; NRU Nauru; NPL Nepal; NLD Netherlands; NZL New Zealand; NIC Nicaragua; NER Niger;
NGA Nigeria; NOR Norway; PSE Occupied Palestinian Territory; OMN Oman; PAK Pakistan; PLW Palau; PAN Panama; PNG Papua New Guinea;
PRY Paraguay; PER Peru; PHL Philippines; POL Poland; PRT Portugal; PRI Puerto Rico; QAT Qatar; ROM Romania; RUS Russia; RWA Rwanda;
KNA Saint Kitts and Nevis; LCA Saint Lucia; VCT Saint Vincent and the Grenadines; WSM Samoa; SMR San Marino; STP Sao Tome and Principe;
SAU Saudi Arabia; SEN Senegal; SRB Serbia; SYC Seychelles; SLE Sierra Leone; SGP Singapore; SVK Slovakia; SVN Slovenia; SLB Solomon Islands;
SOM Somalia; ZAF South Africa; ESP Spain; LKA Sri Lanka; SDN Sudan; SUR Suriname; SWZ Swaziland; SWE Sweden; CHE Switzerland; SYR Syria;
TWN Taiwan; TJK Tajikistan; TZA Tanzania; THA Thailand; TGO Togo; TON Tonga; TTO Trinidad and Tobago; TUN Tunisia; TUR Turkey;
TKM Turkmenistan; TUV Tuvalu; UGA Uganda; UKR Ukraine; ARE United Arab Emirates; GBR United Kingdom; USA United States; URY Uruguay;
UZB Uzbekistan; VUT Vanuatu; VEN Venezuela; VNM Vietnam; YEM Yemen; ZMB Zambia; ZWE Zimbabwe
"""
_REGIONS = """
AFR Africa; ASA Asia; BLK Balkans; CRB Caribbean; CAU Caucasus; CFR Central Africa; CAS Central Asia; CEU Central Europe; EIN East Indies;
EAF Eastern Africa; EEU Eastern Europe; EUR Europe; LAM Latin America; MEA Middle East; MDT Mediterranean; NAF North Africa; NMR North America;
PGS Persian Gulf; SCN Scandinavia; SAM South America; SAS South Asia; SEA Southeast Asia; SAF Southern Africa; WAF West Africa; WST The West
"""
# Public FIPS 10-4 country codes.
_FIPS = """
AF Afghanistan; AL Albania; AG Algeria; AN Andorra; AO Angola; AC Antigua and Barbuda; AR Argentina; AM Armenia; AS Australia; AU Austria;
AJ Azerbaijan; BF Bahamas, The; BA Bahrain; BG Bangladesh; BB Barbados; BO Belarus; BE Belgium; BH Belize; BN Benin; BT Bhutan; BL Bolivia;
BK Bosnia-Herzegovina; BC Botswana; BR Brazil; BX Brunei; BU Bulgaria; UV Burkina Faso; BM Burma; BY Burundi; CB Cambodia; CM Cameroon;
CA Canada; CV Cape Verde; CT Central African Republic; CD Chad; CI Chile; CH China; CO Colombia; CN Comoros;
CG Congo, Democratic Republic of the; CF Congo, Republic of the; CS Costa Rica; IV Cote d'Ivoire; HR Croatia; CU Cuba; CY Cyprus;
EZ Czech Republic; DA Denmark; DJ Djibouti; DO Dominica; DR Dominican Republic; TT East Timor; EC Ecuador; EG Egypt; ES El Salvador;
EK Equatorial Guinea; ER Eritrea; EN Estonia; ET Ethiopia; FJ Fiji; FI Finland; FR France; GB Gabon; GA Gambia, The; GZ Gaza Strip;
GG Georgia; GM Germany; GH Ghana; GR Greece; GL Greenland; GJ Grenada; GT Guatemala; GV Guinea; PU Guinea-Bissau; GY Guyana; HA Haiti;
HO Honduras; HK Hong Kong; HU Hungary; IC Iceland; IN India; ID Indonesia; IR Iran; IZ Iraq; EI Ireland; IS Israel; IT Italy; JM Jamaica;
JA Japan; JQ Johnston Atoll; JO Jordan; KZ Kazakhstan; KE Kenya; KR Kiribati; KN Korea, North; KS Korea, South; KV Kosovo; KU Kuwait;
KG Kyrgyzstan; LA Laos; LG Latvia; LE Lebanon; LT Lesotho; LI Liberia; LY Libya; LS Liechtenstein; LH Lithuania; LU Luxembourg; MC Macau;
MK Macedonia; MA Madagascar; MI Malawi; MY Malaysia; MV Maldives; ML Mali; MT Malta; RM Marshall Islands; MR Mauritania; MP Mauritius;
MX Mexico; FM Micronesia; MQ Midway Islands; MD Moldova; MN Monaco; MG Mongolia; MJ Montenegro; MO Morocco; MZ Mozambique; WA Namibia;
NR Nauru; NP Nepal; NL Netherlands; NZ New Zealand; NU Nicaragua; NG Niger; NI Nigeria; NO Norway; MU Oman; PK Pakistan; PS Palau;
PM Panama; PP Papua New Guinea; PA Paraguay; PE Peru; RP Philippines; PL Poland; PO Portugal; RQ Puerto Rico; QA Qatar; RO Romania;
RS Russia; RW Rwanda; SC Saint Kitts and Nevis; ST Saint Lucia; VC Saint Vincent and the Grenadines; WS Samoa; SM San Marino;
TP Sao Tome and Principe; SA Saudi Arabia; SG Senegal; RI Serbia; SE Seychelles; SL Sierra Leone; SN Singapore; LO Slovakia; SI Slovenia;
BP Solomon Islands; SO Somalia; SF South Africa; OD South Sudan; SP Spain; CE Sri Lanka; SU Sudan; NS Suriname; WZ Swaziland; SW Sweden;
SZ Switzerland; SY Syria; TW Taiwan; TI Tajikistan; TZ Tanzania; TH Thailand; TO Togo; TN Tonga; TD Trinidad and Tobago; TS Tunisia;
TU Turkey; TX Turkmenistan; TV Tuvalu; UG Uganda; UP Ukraine; AE United Arab Emirates; UK United Kingdom; US United States; UY Uruguay;
UZ Uzbekistan; NH Vanuatu; VT Vatican City; VE Venezuela; VM Vietnam; WE West Bank; YM Yemen; ZA Zambia; ZI Zimbabwe
"""
# Public CAMEO codes of peoples, organizations, religions and kinds of actor.
_ETHNIC = "AAR Afar; ARB Arab; ARM Armenian; AZE Azerbaijani; BAL Baluch; BEN Bengali; CHE Chechen; HAU Hausa; HUT Hutu; IGB Igbo; JEW Jewish; KUR Kurd; MAY Maya; PAS Pashtun; PUN Punjabi; ROM Roma; SER Serb; SHO Shona; SIN Sinhalese; SOM Somali; TAM Tamil; TAT Tatar; TIB Tibetan; TUR Turkish; TUT Tutsi; UIG Uighur; YOR Yoruba; ZUL Zulu"
_GROUPS = """
ABD Arab Bank for Economic Development in Africa; ACC Arab Cooperation Council; ADB Asian Development Bank; AEU Arab Economic Unity Council;
AFB African Development Bank; ALQ Al Qaeda; AMN Amnesty International; AMU Arab Maghreb Union; APE Organization of Arab Petroleum Exporting Countries;
ARL Arab League; ASN Association of Southeast Asian Nations; ATD Eastern and Southern African Trade and Development Bank; AUN African Union;
BCA Bank of Central African States (BEAC); BIS Bank for International Settlements;
CEM Monetary and Economic Community of Central Africa (CEMAC), also used of the Common Market for Eastern and Southern Africa;
CIS Commonwealth of Independent States; COE Council of Europe; CWN Commonwealth of Nations; EBR European Bank for Reconstruction and Development;
ECA Economic Community of Central African States; EEC European Union; EFT European Free Trade Association; FAO United Nations Food and Agriculture Organization;
FID International Federation for Human Rights (FIDH); GOE Group of Eight; GOS Group of Seven; HMS Hamas; HRW Human Rights Watch;
IAE International Atomic Energy Agency; ICC International Criminal Court; ICG International Crisis Group; ICJ International Court of Justice; ILO International Labour Organization;
IMF International Monetary Fund; IOM International Organization for Migration; IPU Inter-Parliamentary Union; ITP Interpol; MSF Medecins Sans Frontieres;
NAT North Atlantic Treaty Organization (NATO); NON Non-Aligned Movement (Organization of Non-Aligned Countries); OAS Organization of American States; OIC Organization of Islamic Conferences (OIC);
OPC Organization of Petroleum Exporting Countries; PLO Palestine Liberation Organization; RCR Red Cross; RCS Red Crescent; SCE Council of Security and Cooperation in Europe (OSCE);
TAL Taliban; UNO United Nations; WBK World Bank; WEF World Economic Forum; WFP World Food Program; WHO World Health Organization; WTO World Trade Organization
"""
_RELIGION = "ADR African Diasporic Religion; ALE Alewi; ATH Agnostic; BAH Bahai Faith; BUD Buddhism; CHR Christianity; CON Confucianism; CPT Coptic; CTH Catholic; DOX Orthodox; DRZ Druze; HIN Hinduism; HSD Hasidic; ITR Indigenous Tribal Religion; JAN Jainism; JEW Judaism; JHW Jehovah's Witnesses; LDS Latter Day Saints; MOS Islam; MRN Maronite Church; NRM New Religious Movement; PAG Pagan; PRO Protestant; SFI Sufi; SHI Shia; SHN Old Shinto School; SIK Sikh; SUN Sunni; TAO Taoist; UDX Ultra-Orthodox; ZRO Zoroastrianism"
_TYPES = """
COP Police forces, officers; GOV Government: the executive, governing parties, coalition partners; INS Insurgents; JUD Judiciary: judges, courts; MIL Military: troops, soldiers, all state-military personnel;
OPP Political opposition: opposition parties, individuals, anti-government activists; REB Rebels: armed and violent opposition groups, individuals; SEP Separatist rebels; SPY State intelligence services and members;
UAF Armed forces that aren't aligned; AGR Agriculture; BUS Business; CRM Criminal; CVL Civilian; DEV Development; EDU Education; ELI Elites; ENV Environmental; HLH Health; HRI Human rights; LAB Labor; LEG Legislature; MED Media;
REF Refugees; MOD Moderate; RAD Radical; IGO Inter-governmental organization; IMG International militarized group; INT International or transnational, not specified; MNC Multinational corporation; NGM Non-governmental movement;
NGO Non-governmental organization; SET Settler; UIS Unidentified state actor
"""
# Public CAMEO event codes, roots and bases.
_EVENT_ROOTS = """
01 MAKE PUBLIC STATEMENT; 02 APPEAL; 03 EXPRESS INTENT TO COOPERATE; 04 CONSULT; 05 ENGAGE IN DIPLOMATIC COOPERATION; 06 ENGAGE IN MATERIAL COOPERATION;
07 PROVIDE AID; 08 YIELD; 09 INVESTIGATE; 10 DEMAND; 11 DISAPPROVE; 12 REJECT; 13 THREATEN; 14 PROTEST; 15 EXHIBIT FORCE POSTURE; 16 REDUCE RELATIONS;
17 COERCE; 18 ASSAULT; 19 FIGHT; 20 USE UNCONVENTIONAL MASS VIOLENCE
"""
_EVENT_BASES = """
010 Make statement, not specified below; 011 Decline comment; 012 Make pessimistic comment; 013 Make optimistic comment; 014 Consider policy option; 015 Acknowledge or claim responsibility;
016 Deny responsibility; 017 Engage in symbolic act; 018 Make empathetic comment; 019 Express accord; 020 Make an appeal or request, not specified below; 021 Appeal for material cooperation, not specified below;
022 Appeal for diplomatic cooperation, such as policy support; 023 Appeal for aid, not specified below; 024 Appeal for political reform, not specified below; 025 Appeal to yield, not specified below;
026 Appeal to others to meet or negotiate; 027 Appeal to others to settle dispute; 028 Appeal to others to engage in or accept mediation; 030 Express intent to cooperate, not specified below;
031 Express intent to engage in material cooperation, not specified below; 032 Express intent to provide diplomatic cooperation such as policy support; 033 Express intent to provide material aid, not specified below;
034 Express intent to institute political reform, not specified below; 035 Express intent to yield, not specified below; 036 Express intent to meet or negotiate; 037 Express intent to settle dispute; 038 Express intent to accept mediation;
039 Express intent to mediate; 040 Consult, not specified below; 041 Discuss by telephone; 042 Make a visit; 043 Host a visit; 044 Meet at a third location; 045 Mediate; 046 Engage in negotiation;
050 Engage in diplomatic cooperation, not specified below; 051 Praise or endorse; 052 Defend verbally; 053 Rally support on behalf of; 054 Grant diplomatic recognition; 055 Apologize; 056 Forgive; 057 Sign formal agreement;
060 Engage in material cooperation, not specified below; 061 Cooperate economically; 062 Cooperate militarily; 063 Engage in judicial cooperation; 064 Share intelligence or information; 070 Provide aid, not specified below;
071 Provide economic aid; 072 Provide military aid; 073 Provide humanitarian aid; 074 Provide military protection or peacekeeping; 075 Grant asylum; 080 Yield, not specified below; 081 Ease administrative sanctions, not specified below;
082 Ease political dissent; 083 Accede to requests or demands for political reform, not specified below; 084 Return, release, not specified below; 085 Ease economic sanctions, boycott, embargo; 086 Allow international involvement, not specified below;
087 De-escalate military engagement; 090 Investigate, not specified below; 091 Investigate crime, corruption; 092 Investigate human rights abuses; 093 Investigate military action; 094 Investigate war crimes; 100 Demand, not specified below;
101 Demand material cooperation, not specified below; 102 Demand diplomatic cooperation, such as policy support; 103 Demand material aid, not specified below; 104 Demand political reform, not specified below; 105 Demand that target yields, not specified below;
106 Demand meeting, negotiation; 107 Demand settling of dispute; 108 Demand mediation; 110 Disapprove, not specified below; 111 Criticize or denounce; 112 Accuse, not specified below; 113 Rally opposition against; 114 Complain officially; 115 Bring lawsuit against; 116 Find guilty or liable (legally);
120 Reject, not specified below; 121 Reject material cooperation; 122 Reject request or demand for material aid, not specified below; 123 Reject request or demand for political reform, not specified below; 124 Refuse to yield, not specified below; 125 Reject proposal to meet, discuss, or negotiate;
126 Reject mediation; 127 Reject plan, agreement to settle dispute; 128 Defy norms, law; 129 Veto; 130 Threaten, not specified below; 131 Threaten non-force, not specified below; 132 Threaten with administrative sanctions, not specified below; 133 Threaten with political dissent, protest;
134 Threaten to halt negotiations; 135 Threaten to halt mediation; 136 Threaten to halt international involvement (non-mediation); 137 Threaten with violent repression; 138 Threaten with military force, not specified below; 139 Give ultimatum; 140 Engage in political dissent, not specified below;
141 Demonstrate or rally, not specified below; 142 Conduct hunger strike, not specified below; 143 Conduct strike or boycott, not specified below; 144 Obstruct passage, block, not specified below; 145 Protest violently, riot, not specified below; 150 Exhibit military or police power, not specified below;
151 Increase police alert status; 152 Increase military alert status; 153 Mobilize or increase police power; 154 Mobilize or increase armed forces; 160 Reduce relations, not specified below; 161 Reduce or break diplomatic relations; 162 Reduce or stop aid, not specified below; 163 Impose embargo, boycott, or sanctions;
164 Halt negotiations; 165 Halt mediation; 166 Expel or withdraw, not specified below; 170 Coerce, not specified below; 171 Seize or damage property, not specified below; 172 Impose administrative sanctions, not specified below; 173 Arrest, detain, or charge with legal action; 174 Expel or deport individuals; 175 Use tactics of violent repression;
180 Use unconventional violence, not specified below; 181 Abduct, hijack, or take hostage; 182 Physically assault, not specified below; 183 Conduct suicide, car, or other non-military bombing, not specified below; 184 Use as human shield; 185 Attempt to assassinate; 186 Assassinate; 190 Use conventional military force, not specified below;
191 Impose blockade, restrict movement; 192 Occupy territory; 193 Fight with small arms and light weapons; 194 Fight with artillery and tanks; 195 Employ aerial weapons; 196 Violate ceasefire; 200 Use unconventional mass violence, not specified below; 201 Engage in mass expulsion; 202 Engage in mass killings; 203 Engage in ethnic cleansing; 204 Use weapons of mass destruction, not specified below
"""
# What the last digit of a four-digit code adds to its base, for the series that recur; %s is the act.
_COOPERATION = ("%s economic cooperation", "%s military cooperation", "%s judicial cooperation", "%s intelligence cooperation")
_AID = ("%s economic aid", "%s military aid", "%s humanitarian aid", "%s military protection or peacekeeping")
_REFORM = ("%s change in leadership", "%s policy change", "%s rights", "%s change in institutions, regime")
_YIELDING = ("%s easing of administrative sanctions", "%s easing of political dissent", "%s release of persons or property", "%s easing of economic sanctions, boycott, or embargo", "%s allowing of international involvement", "%s de-escalation of military engagement")
_DISSENT = ("%s for leadership change", "%s for policy change", "%s for rights", "%s for change in institutions, regime")
_SERIES = (
    (_COOPERATION, {"021": "Appeal for", "031": "Express intent to engage in", "101": "Demand", "121": "Reject"}),
    (_AID, {"023": "Appeal for", "033": "Express intent to provide", "103": "Demand", "122": "Reject request for"}),
    (_REFORM, {"024": "Appeal for", "034": "Express intent to institute", "083": "Accede to demands for", "104": "Demand", "123": "Reject request for"}),
    (_YIELDING, {"025": "Appeal for", "035": "Express intent of", "105": "Demand", "124": "Refuse"}),
    (_DISSENT, {"141": "Demonstrate", "142": "Conduct hunger strike", "143": "Conduct strike or boycott", "144": "Obstruct passage", "145": "Engage in violent protest"}),
)
# Four-digit codes outside of those series.
_EVENT_OTHERS = """
0811 Ease restrictions on political freedoms; 0812 Ease ban on political parties or politicians; 0813 Ease curfew; 0814 Ease state of emergency or martial law; 0841 Return, release person(s); 0842 Return, release property;
0861 Receive deployment of peacekeepers; 0862 Receive inspectors; 0863 Allow humanitarian access; 0871 Declare truce, ceasefire; 0872 Ease military blockade; 0873 Demobilize armed forces; 0874 Retreat or surrender militarily;
1121 Accuse of crime, corruption; 1122 Accuse of human rights abuses; 1123 Accuse of aggression; 1124 Accuse of war crimes; 1125 Accuse of espionage, treason; 1311 Threaten to reduce or stop aid; 1312 Threaten with sanctions, boycott, embargo; 1313 Threaten to reduce or break relations;
1321 Threaten with restrictions on political freedoms; 1322 Threaten to ban political parties or politicians; 1323 Threaten to impose curfew; 1324 Threaten to impose state of emergency or martial law; 1381 Threaten blockade; 1382 Threaten occupation; 1383 Threaten unconventional violence; 1384 Threaten conventional attack; 1385 Threaten attack with WMD;
1621 Reduce or stop economic assistance; 1622 Reduce or stop military assistance; 1623 Reduce or stop humanitarian assistance; 1661 Expel or withdraw peacekeepers; 1662 Expel or withdraw inspectors, observers; 1663 Expel or withdraw aid agencies; 1711 Confiscate property; 1712 Destroy property;
1721 Impose restrictions on political freedoms; 1722 Ban political parties or politicians; 1723 Impose curfew; 1724 Impose state of emergency or martial law; 1821 Sexually assault; 1822 Torture; 1823 Kill by physical assault; 1831 Carry out suicide bombing; 1832 Carry out vehicular bombing; 1833 Carry out roadside bombing; 1834 Carry out location bombing;
1951 Employ precision-guided aerial munitions; 1952 Employ remotely piloted aerial munitions; 2041 Use chemical, biological, or radiological weapons; 2042 Detonate nuclear weapons
"""


def _events() -> dict[str, str]:
    out = _codes(_EVENT_ROOTS) | _codes(_EVENT_BASES) | _codes(_EVENT_OTHERS)
    for names, bases in _SERIES:
        out |= {f"{base}{i}": name % act for base, act in bases.items() for i, name in enumerate(names, 1)}
    return out


FAMILIES: dict[str, dict[str, str]] = {
    "actor_country": _codes(_STATES) | _codes(_REGIONS), "geo_country": _codes(_FIPS), "ethnic": _codes(_ETHNIC), "known_group": _codes(_GROUPS),
    "religion": _codes(_RELIGION), "actor_type": _codes(_TYPES), "event": _events(),
}
NAMES = {
    "actor_country": "Actor country (three letters)", "geo_country": "Geographic country (two letters)", "ethnic": "Ethnic group", "known_group": "Known group",
    "religion": "Religion", "actor_type": "Actor type", "event": "Event",
}
#: Families whose lists are whole: a code outside of them is wrong.
WHOLE = {"event"}
#: Names of the published list files, `CODE<tab>LABEL` lines under a heading.
LIST_FILES = {
    "CAMEO.country.txt": "actor_country", "FIPS.country.txt": "geo_country", "CAMEO.ethnic.txt": "ethnic", "CAMEO.knowngroup.txt": "known_group",
    "CAMEO.religion.txt": "religion", "CAMEO.type.txt": "actor_type", "CAMEO.eventcodes.txt": "event",
}


def _columns() -> dict[str, str]:
    out: dict[str, str] = {}
    for a in ("Actor1", "Actor2"):
        out[f"{a}CountryCode"] = "actor_country"
        out[f"{a}KnownGroupCode"] = "known_group"
        out[f"{a}EthnicCode"] = "ethnic"
        out |= {f"{a}Religion{i}Code": "religion" for i in (1, 2)}
        out |= {f"{a}Type{i}Code": "actor_type" for i in (1, 2, 3)}
        out[f"{a}Geo_CountryCode"] = "geo_country"
    out["ActionGeo_CountryCode"] = "geo_country"
    out |= dict.fromkeys(("EventCode", "EventBaseCode", "EventRootCode"), "event")
    return out


COLUMN_FAMILY = _columns()


def family_of(column: str) -> str | None:
    return COLUMN_FAMILY.get(column)


def family_name(column: str) -> str | None:
    return NAMES.get(COLUMN_FAMILY.get(column, ""))


def codes_of(family: str) -> dict[str, str]:
    """Code to name of a family, as far as it is known here."""
    if family not in FAMILIES:
        raise ValueError(f"unknown family {family!r}")
    return dict(FAMILIES[family])


def actor_country_codes() -> dict[str, str]:
    return codes_of("actor_country")


def geo_country_codes() -> dict[str, str]:
    return codes_of("geo_country")


def ethnic_codes() -> dict[str, str]:
    return codes_of("ethnic")


def known_group_codes() -> dict[str, str]:
    return codes_of("known_group")


def religion_codes() -> dict[str, str]:
    return codes_of("religion")


def type_codes() -> dict[str, str]:
    return codes_of("actor_type")


def event_codes() -> dict[str, str]:
    return codes_of("event")


def codes_for_column(column: str) -> dict[str, str] | None:
    """Code to name of the column's family; None for columns without one."""
    family = COLUMN_FAMILY.get(column)
    return None if family is None else codes_of(family)


def is_recognized(column: str, value: str) -> bool | None:
    """Is the code in its column's family, whatever its case?  None for columns without one, and for a code that a list with gaps doesn't have."""
    family = COLUMN_FAMILY.get(column)
    if family is None:
        return None
    if value.upper() in {c.upper() for c in FAMILIES[family]}:
        return True
    shape = {"actor_country": 3, "geo_country": 2}.get(family)
    return False if family in WHOLE or (shape is not None and len(value) != shape) else None


def extend(family: str, codes: dict[str, str], whole: bool = False) -> None:
    """Add codes; `whole` says that the family has no others."""
    codes_of(family)
    FAMILIES[family].update(codes)
    if whole:
        WHOLE.add(family)


def load_list(path: str, family: str) -> int:
    """Add a published list file; the family then counts as whole.  Returns how many codes it has."""
    lines = Path(path).read_text(encoding="utf-8").splitlines()
    rows = [line.split("\t") for line in lines if "\t" in line]
    found = {r[0].strip(): r[1].strip() for r in rows if r[0].strip() and r[0].strip().upper() not in ("CODE", "CAMEOEVENTCODE")}
    # what the engine's own list says of a code stays
    extend(family, found | FAMILIES[family], whole=True)
    return len(found)


def load_folder(folder: str) -> dict[str, int]:
    """Add those published list files that a folder has; codes by family."""
    return {f: load_list(os.path.join(folder, name), f) for name, f in LIST_FILES.items() if os.path.exists(os.path.join(folder, name))}


def list_families() -> dict[str, tuple[str, list[str]]]:
    """Family to (display name, its columns)."""
    return {f: (NAMES[f], [c for c, g in COLUMN_FAMILY.items() if g == f]) for f in FAMILIES}


def list_codes(column: str, search: str | None = None) -> list[tuple[str, str]]:
    """(code, name) of the column's family by code, those that hold the term in either, whatever its case."""
    if column not in COLUMN_FAMILY:
        raise ValueError(f"{column!r} has no code list; columns that have: {sorted(COLUMN_FAMILY)}")
    codes = sorted(FAMILIES[COLUMN_FAMILY[column]].items())
    term = (search or "").lower()
    return [(c, n) for c, n in codes if term in c.lower() or term in n.lower()]


def unrecognized_values(df: DataFrame, column: str) -> DataFrame:
    """(value, n): the values of a coded column that its family doesn't have, whatever their case; null isn't one."""
    known = df.sparkSession.createDataFrame([(c.upper(),) for c in codes_for_column(column) or ()], "_code string")
    counts = df.where(F.col(f"`{column}`").isNotNull()).groupBy(F.col(f"`{column}`")).agg(F.count("*").alias("n"))
    return counts.join(known, F.upper(F.col(f"`{column}`")) == F.col("_code"), "left_anti")


def codes_table(spark: SparkSession) -> DataFrame:
    rows = [(f, c, n) for f, codes in FAMILIES.items() for c, n in codes.items()]
    return spark.createDataFrame(rows, "family string, code string, name string")
