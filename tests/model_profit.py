"""The item set and the measures in plain Python, one row at a time.

Nothing here knows of weights, sums by code or factorised families: the item set is a list with
its repeated rows, and every fact row is counted once for each item row it meets.
Codes are compared without case and trailing blanks.  Used to check the Spark job
independently of the SQL oracle.
"""

import datetime as dt
from collections import Counter, defaultdict
from decimal import ROUND_DOWN, ROUND_HALF_UP, Decimal, localcontext

COLUMNS = {
    "product_master": "ItemCode Title ISBN Cost Price MSRP SectionCode VendorID Line Reorderable Alias",
    "product_master_dist": "ItemCode Report UPC",
}
FOLDED = {"ItemCode", "Report", "Line", "Reorderable", "Alias"}


def fold(x):
    return x.rstrip(" ").upper() if isinstance(x, str) else x


def pad20(code):
    return None if code is None else ("0" * 20 + code)[-20:]


def _decimal(x, places, rounding=ROUND_HALF_UP):
    with localcontext() as ctx:
        ctx.prec = 60
        return None if x is None else x.quantize(Decimal(1).scaleb(-places), rounding)


def _int(x):
    return None if x is None else int(_decimal(x, 0, ROUND_DOWN))


def _ratio(a, b, places):
    with localcontext() as ctx:
        ctx.prec = 60
        return None if a is None or b is None else _decimal(Decimal(a) / b, places)


def _sum(values):
    values = [v for v in values if v is not None]
    return sum(values, Decimal(0)) if values else None


def _records(rows, table):
    names = COLUMNS[table].split()
    return [{n: fold(v) if n in FOLDED else v for n, v in zip(names, r, strict=True)} for r in rows.get(table, [])]


def items(rows, as_of):
    """The item set as a list of (Title, ItemCode, ReportItemCode, ISBN, Cost, Price, MSRP, SectionCode, VendorID, OrgPO, OrgBuyer)."""
    products, dist = _records(rows, "product_master"), _records(rows, "product_master_dist")
    orders = [(fold(p), fold(c)) for p, c in rows.get("order_detail", [])]

    def first_po(code):
        return min((p for p, c in orders if c == code and p is not None), default=None)

    def own(p, d):
        isbn = p["ISBN"] if (p["ISBN"] or "").strip(" ") else d["UPC"]
        report = d["Report"] if d["Report"] is not None else p["ItemCode"]
        return [p["Title"], p["ItemCode"][-7:], report, isbn, p["Cost"], p["Price"], p["MSRP"], p["SectionCode"], p["VendorID"], first_po(p["ItemCode"]), ""]

    pairs = [(p, d) for p in products for d in dist if p["ItemCode"] == d["ItemCode"]]
    line = [(p, d) for p, d in pairs if p["Line"] == "TTB"]
    reorderable = {tuple(own(p, d)) for p, d in line if p["Reorderable"] == "Y"}
    named = {pad20(p["Alias"].replace("UPC", "")) for p in products if (p["Alias"] or "").startswith("UPC")}
    alias = {p["ItemCode"] for p, _ in line if p["ItemCode"] in named}
    family = set(reorderable)
    for p, d in line:
        if p["ItemCode"] not in alias:
            family |= {(r[0], p["ItemCode"][-7:], d["Report"], *r[3:]) for r in reorderable if r[2] == d["Report"]}
    found = [list(r) for r in family]
    for p, d in line:
        if p["ItemCode"] in alias:
            found += [own(p, d) for r in reorderable if r[2] == d["Report"]]
    flip = {r[2] for r in reorderable if pad20(r[1]) != pad20(r[2])}
    for r in found:
        if r[2] in flip:
            r[2] = pad20(max(c[1] for c in reorderable if c[2] == r[2]))
    end = dt.datetime.fromisoformat(as_of)
    late = {pad20(fold(i)) for i, t in rows.get("oos_item_log", []) if t > end.replace(year=end.year - 1)}
    tracked = {r[1] for r in found}
    found += [list(r) for r in {tuple(own(p, d)) for p, d in pairs if p["ItemCode"] in late and p["ItemCode"][-7:] not in tracked}]
    for r in found:
        heads = [b for p, b in rows.get("order_header", []) if fold(p) == r[9] and r[9] is not None]
        if heads:
            r[10] = max((b for b in heads if b is not None), default=None)
    return [tuple(r) for r in found]


def _meet(bag, facts, code_of):
    """(item row, fact) for every item row and every fact of its code."""
    by_code = defaultdict(list)
    for f in facts:
        by_code[fold(code_of(f))].append(f)
    return [(i, f) for i in bag for f in by_code[i[1]]]


def _grouped(met, key):
    out = defaultdict(list)
    for i, f in met:
        out[key(i)].append((i, f))
    return out


def receipts(bag, rows):
    """Receipt feeds: (item, first date, quantity, amount); equal rows of the two feeds count once."""
    out = set()
    for head, lines in (("receipt_header", "receipt_detail"), ("ar_receipt_header", "ar_receipt_detail")):
        facts = [(h[1], d[1], d[2]) for h in rows.get(head, []) for d in rows.get(lines, []) if h[0] == d[0]]
        for code, met in _grouped(_meet(bag, facts, lambda f: f[1]), lambda i: i[1]).items():
            total, cost = _sum(f[2] for _, f in met), max((i[4] for i, _ in met if i[4] is not None), default=None)
            amount = None if total is None or cost is None else _decimal(total * cost, 4)
            out.add((code, min(f[0] for _, f in met), _int(sum((f[2] or Decimal(0) for _, f in met), Decimal(0))), amount))
    return Counter(out)


def legacy(bag, rows):
    facts = [
        (h[1], d[1], d[2], d[3])
        for h in rows.get("pop_receipt_header", [])
        for d in rows.get("pop_receipt_line", [])
        if fold(h[0]) == fold(d[0]) and h[2] == 1 and h[1] < dt.datetime(2010, 6, 30)
    ]
    out = Counter()
    for code, met in _grouped(_meet(bag, facts, lambda f: f[1]), lambda i: i[1]).items():
        parts = [_ratio(f[2], Decimal(1) if f[3] == 0 else f[3], 19) or Decimal(0) for _, f in met]
        out[(code, min(f[0] for _, f in met), _int(sum(parts, Decimal(0))), _decimal(sum((f[2] or Decimal(0) for _, f in met), Decimal(0)), 4))] += 1
    return out


def store_ship(bag, rows):
    facts = [d for h in rows.get("transfer_header", []) for d in rows.get("transfer_detail", []) if h[0] == d[0]]
    by_code = [(*i[:1], pad20(i[1]), *i[2:]) for i in bag]
    out = set()
    for (code, cost), met in _grouped(_meet(by_code, facts, lambda f: f[1]), lambda i: (i[1], i[4])).items():
        total = _sum(f[2] for _, f in met)
        out.add((code[-7:], _int(total), None if total is None or cost is None else _decimal(total * cost, 4)))
    return Counter(out)


def store_sales(bag, rows):
    shops = Counter()
    for r in rows.get("locations", []):
        number = (r[1] or "").strip()
        if fold(r[3]) == "Y" and fold(r[4]) == "A" and number.isdigit() and 1 <= int(number) <= 200:
            shops[fold(r[0])] += 1
    facts = [s for s in rows.get("sales_item_history", []) if fold(s[7]) == "S" for _ in range(shops[fold(s[0])])]
    by_code = [(*i[:1], pad20(i[1]), *i[2:]) for i in bag]
    out = Counter()
    for code, met in _grouped(_meet(by_code, facts, lambda f: f[1]), lambda i: i[1]).items():
        net = _sum(None if f[3] is None else -f[3] if fold(f[2]) == "Y" else f[3] for _, f in met)
        amounts = [f[4] for _, f in met if f[4] is not None]
        marked = sum(1 for _, f in met if fold(f[2]) == "N" and None not in (f[5], f[6]) and f[5] > f[6])
        out[(code[-7:], _decimal(net or Decimal(0), 5), _decimal(_sum(amounts), 4), _ratio(_sum(amounts), len(amounts), 4) if amounts else None, marked)] += 1
    return out


def wholesale(bag, rows):
    feeds = set()
    for head, lines in (("sop_open_header", "sop_open_line"), ("sop_hist_header", "sop_hist_line")):
        keep = []
        for h in rows.get(head, []):
            customer, doc, batch = fold(h[2]), fold(h[3]), fold(h[4])
            outside = customer is not None and customer not in ("SAMPLE", "REPS") and not customer.startswith(("MRDC", "RDC", "TTB"))
            if h[1] == 3 and outside and doc == "STD" and batch is not None and batch != "SALES VOID":
                keep.append(fold(h[0]))
        facts = [d for k in keep for d in rows.get(lines, []) if fold(d[0]) == k]
        for code, met in _grouped(_meet(bag, facts, lambda f: f[1]), lambda i: i[1]).items():
            q, a = _sum(f[2] for _, f in met), _sum(f[3] for _, f in met)
            average = Decimal(0) if q == 0 else _ratio(a, q, 6)
            feeds.add((code, _decimal(q, 5), _decimal(a, 5), _decimal(average, 6)))
    by_code, out = defaultdict(list), Counter()
    for f in feeds:
        by_code[f[0]].append(f)
    for code, fs in by_code.items():
        averages = [f[3] for f in fs if f[3] is not None]
        mean = _ratio(sum(averages), len(averages), 6) if averages else None
        out[(code, _sum(f[1] for f in fs), _sum(f[2] for f in fs), mean)] += 1
    return out
