"""Phone numbers to E.164 with native string functions.

A number is read as international when it opens with ``+`` (or the dialling
prefix of its region) and as national otherwise. An international number is kept
if it begins with any assigned calling code, whatever its region says; a national one
needs a known region. Numbers of impossible length give NULL.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# The ITU's assigned calling codes, each with the regions that share it. Codes without a region are
# those of satellite networks and international services.
_ASSIGNED = """
1 US CA PR DO JM AG AI AS BB BM BS DM GD GU KN KY LC MP MS SX TC TT VC VG VI
20 EG 211 SS 212 MA EH 213 DZ 216 TN 218 LY 220 GM 221 SN 222 MR 223 ML 224 GN 225 CI 226 BF 227 NE 228 TG 229 BJ
230 MU 231 LR 232 SL 233 GH 234 NG 235 TD 236 CF 237 CM 238 CV 239 ST 240 GQ 241 GA 242 CG 243 CD 244 AO 245 GW 246 IO
247 AC 248 SC 249 SD 250 RW 251 ET 252 SO 253 DJ 254 KE 255 TZ 256 UG 257 BI 258 MZ 260 ZM 261 MG 262 RE YT 263 ZW
264 NA 265 MW 266 LS 267 BW 268 SZ 269 KM 27 ZA 290 SH TA 291 ER 297 AW 298 FO 299 GL
30 GR 31 NL 32 BE 33 FR 34 ES 350 GI 351 PT 352 LU 353 IE 354 IS 355 AL 356 MT 357 CY 358 FI AX 359 BG 36 HU 370 LT
371 LV 372 EE 373 MD 374 AM 375 BY 376 AD 377 MC 378 SM 380 UA 381 RS 382 ME 383 XK 385 HR 386 SI 387 BA 389 MK 39 IT VA
40 RO 41 CH 420 CZ 421 SK 423 LI 43 AT 44 GB GG IM JE 45 DK 46 SE 47 NO SJ 48 PL 49 DE
500 FK GS 501 BZ 502 GT 503 SV 504 HN 505 NI 506 CR 507 PA 508 PM 509 HT 51 PE 52 MX 53 CU 54 AR 55 BR 56 CL 57 CO 58 VE
590 GP BL MF 591 BO 592 GY 593 EC 594 GF 595 PY 596 MQ 597 SR 598 UY 599 CW BQ
60 MY 61 AU CC CX 62 ID 63 PH 64 NZ 65 SG 66 TH 670 TL 672 NF 673 BN 674 NR 675 PG 676 TO 677 SB 678 VU 679 FJ 680 PW
681 WF 682 CK 683 NU 685 WS 686 KI 687 NC 688 TV 689 PF 690 TK 691 FM 692 MH
7 RU KZ
800 808 81 JP 82 KR 84 VN 850 KP 852 HK 853 MO 855 KH 856 LA 86 CN 870 878 880 BD 881 882 883 886 TW 888
90 TR 91 IN 92 PK 93 AF 94 LK 95 MM 960 MV 961 LB 962 JO 963 SY 964 IQ 965 KW 966 SA 967 YE 968 OM 970 PS 971 AE
972 IL 973 BH 974 QA 975 BT 976 MN 977 NP 979 98 IR 992 TJ 993 TM 994 AZ 995 GE 996 KG 998 UZ
"""
# What is dialled before a national number where it is not "0"; "-" for nothing.
_TRUNKS = """
1 US CA PR DO JM AG AI AS BB BM BS DM GD GU KN KY LC MP MS SX TC TT VC VG VI
8 RU KZ BY TM
06 HU
- GR ES PT LU IS MT CY EE LV CZ DK NO SJ PL IT VA SM MC AD GI MX CL GT SV HN NI CR PA BZ HT TN LY GM SN MR ML GN CI BF NE TG
- BJ MU TD CF CM CV ST GQ GA CG GW SC DJ BI RW LS SZ KM MZ SH TA SG HK MO QA KW BH OM BT MV FO GL AW CW BQ FK GS FJ PG TO SB VU
- NR KI TV WS CK NU TK WF NC PF PW FM MH NF TL BN SR GY IO AC AO
"""


def _by_region() -> tuple[dict[str, tuple[str, str]], list[str]]:
    """``region -> (calling code, trunk prefix)``, and all assigned codes."""
    trunks: dict[str, str] = {}
    for line in _TRUNKS.split("\n"):
        trunk, *regions = line.split() or [""]
        trunks.update(dict.fromkeys(regions, "" if trunk == "-" else trunk))
    codes: dict[str, tuple[str, str]] = {}
    assigned: list[str] = []
    for word in _ASSIGNED.split():
        if word.isdigit():
            assigned.append(word)
        else:
            codes[word] = (assigned[-1], trunks.get(word, "0"))
    return codes, assigned


CALLING_CODES, ASSIGNED_CODES = _by_region()


@dataclass(frozen=True)
class Limits:
    """Digits of a whole international number (E.164 allows 15)."""

    shortest: int = 8
    longest: int = 15
    national_shortest: int = 5
    american: int = 10


def e164(
    phone: Column,
    region: Column,
    codes: dict[str, tuple[str, str]] = CALLING_CODES,
    default: str = "US",
    limits: Limits = Limits(),
) -> Column:
    """``phone`` as ``+<calling code><national number>``, or NULL."""
    code_map = F.create_map(*[F.lit(x) for r, (c, _) in codes.items() for x in (r, c)])
    trunk_map = F.create_map(*[F.lit(x) for r, (_, t) in codes.items() for x in (r, t)])
    known = "|".join(sorted({c for c, _ in codes.values()} | set(ASSIGNED_CODES), key=lambda c: (-len(c), c)))

    place = F.when(F.length(region) == 2, F.upper(region)).otherwise(F.lit(default))
    body = F.regexp_replace(F.trim(phone), r"(?i)\s*(ext\.?|x|#)\s*\d+$", "")
    digits = F.regexp_replace(body, "[^0-9]", "")
    code = F.try_element_at(code_map, place)
    trunk = F.try_element_at(trunk_map, place)
    american = code == "1"

    abroad = F.when(american, F.lit("011")).otherwise(F.lit("00"))
    international = body.startswith("+") | digits.startswith(abroad)
    outside = F.when(body.startswith("+"), digits).otherwise(F.substr(digits, F.length(abroad) + 1))
    home = F.when((trunk != "") & digits.startswith(trunk), F.substr(digits, F.length(trunk) + 1)).otherwise(digits)

    whole = F.when(international, outside).otherwise(F.concat(code, home))
    fits = F.length(whole).between(limits.shortest, limits.longest) & F.when(
        international, whole.rlike(f"^({known})")
    ).otherwise(
        F.when(american, F.length(home) == limits.american).otherwise(F.length(home) >= limits.national_shortest)
    )
    plus_one = whole.startswith("1")
    fits = fits & (~(international & plus_one) | (F.length(whole) == limits.american + 1))
    return F.when(~body.rlike("[A-Za-z]") & fits, F.concat(F.lit("+"), whole))
