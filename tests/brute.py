"""Plain Python statements of the text rules, to compare the Spark expressions with."""

import re

I = re.IGNORECASE
D = "[-–—]"
N = r"\d{1,%d}(?:\.\d+)?"
U = "(v|vac|vdc|⎓)"
VOLT = re.compile(
    rf"(?:\b(?:ac|dc)\b\W{{0,3}})?(?:({N % 3})\s*{U}?\s*(?:{D}|/)\s*({N % 3})\s*{U}?"
    rf"|({N % 3})\s*{U}|(?:rated\s+)?voltage\s*[:\-]?\s*({N % 4})\s*{U}?"
    rf"|['\"]?name['\"]?\s*[:=]\s*['\"]?voltage['\"]?\s*,\s*['\"]?value['\"]?\s*[:=]\s*['\"]?"
    rf"({N % 4})\s*{U}?['\"]?)", I)
AMP = re.compile(rf"({N % 2})(?:\s*(?:{D}|/)\s*({N % 2}))?\s*(ma|a)\b", I)
WATT = re.compile(rf"({N % 4})(?:\s*(?:{D}|/)\s*({N % 4}))?\s*(kw|w)\b", I)
HZ = re.compile(rf"\d{{2,3}}(?:\s*(?:{D}|/)\s*\d{{2,3}})?\s*hz\b", I)
CUES = [
    (3.0, re.compile(r"\b(input|in|ac\s*in|dc\s*in|mains|supply|source|wall|cigarette\s*lighter"
                     r"|vehicle|car|truck|plug\s*in)\b", I)),
    (1.5, re.compile(r"\b(ac|vac|50/60\s*hz|hz)\b", I)),
    (-3.0, re.compile(r"\b(output|out|port|charging|charge|usb[-\s]?(c\d?|a\d?)|type[-\s]?c\d?"
                      r"|type[-\s]?a\d?|pd\s*\d+(\.\d+)?|pps|qc\s*\d(\.\d)?)\b", I)),
    (-1.0, re.compile(r"\b(dc|usb|⎓)\b", I)),
]
PORT = re.compile(r"\b(?:usb[-\s]?([ca])\s*(\d+)?)\b|\b([ca])(\d)\b", I)
BREAK = re.compile(rf"(?<=[.!?;])\s+|\s*[•\-–—]\s+")
NUMBER = r"-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?"
UNIT = r"(?:\s*[a-zA-ZµμΩ°%]+)?"
RANGE = re.compile(rf"(?<![\w./])({NUMBER}){UNIT}(?:\s*{D}\s*({NUMBER}){UNIT})?(?![\w./])")


def chunks(text):
    return [c for c in (p.strip() for p in BREAK.split(text)) if c] or [text]


def values(kind, m):
    if kind == "voltage_info":
        g = m.groups()
        number = f"{g[0]}-{g[2]}" if g[0] else g[4] or g[6] or g[8]
        unit = (g[1] or g[3]) if g[0] else g[5] or g[7] or g[9]
        return f"{number} {(unit or 'V').upper()}"
    lo, hi, unit = m.groups()
    if unit.lower() == "ma":
        lo, hi = (x and str(round(float(x) / 1000, 4)) for x in (lo, hi))
    elif unit.lower() == "kw":
        lo, hi = (x and str(round(float(x) * 1000, 3)) for x in (lo, hi))
    return (f"{lo}-{hi}" if hi else lo) + (" A" if kind == "amperage_info" else " W")


def specs(text):
    found = {}
    for kind, pattern in (("voltage_info", VOLT), ("amperage_info", AMP), ("wattage_info", WATT)):
        contexts = {}
        for chunk in chunks(text):
            port = PORT.search(chunk)
            label = port and "USB-" + (port[1] or port[3]).upper() + (port[2] or port[4] or "")
            for m in pattern.finditer(chunk):
                win = chunk[max(0, m.start() - 40): m.end() + 40]
                balance = sum(w for w, cue in CUES if cue.search(win))
                if balance:
                    base = "input" if balance > 0 else "output"
                elif label:
                    base = "output"
                else:
                    base = "input" if HZ.search(win) or "VAC" in win.upper() else "unspecified"
                entry = contexts.setdefault(f"{base}:{label}" if label else base, [])
                value = values(kind, m)
                if value not in entry:
                    entry.append(value)
        found[kind] = list(contexts.items())
    return found


def number(text):
    m = RANGE.search(text)
    return (None, None) if not m else (float(m[1]), None if m[2] is None else float(m[2]))


def volts_ok(value, exact):
    a, b = number(value)
    if a is None:
        return True
    if b is None:
        return a < 100 or (a == 230 if exact else 230 <= a <= 250)
    a, b = sorted((a, b))
    return b < 100 or (a <= 230 <= b if exact else a >= 230 and b <= 250)


def below_ok(value, limit, exact):
    a, b = number(value)
    if a is None or (b is not None and exact):
        return True
    if b is not None:
        return max(a, b) <= limit
    return (a == limit or a <= 5) if exact else a <= limit


def score(pairs, check, clear, skipped=(), reset=True, quantifier=any):
    total = 0.0
    for context, vals in pairs:
        if any(w in context.lower() for w in skipped):
            continue
        if quantifier(check(v) for v in vals):
            return 0.0 if reset else total
        total += 1.0 if any(w in context.lower() for w in clear) else 0.5
    return total
