"""Plain-Python models of the row-by-row operators, used only as test
oracles on small fixtures (they walk a list in file order, the way the
semantics are defined)."""
import re
from itertools import takewhile

ENDS = [".com", ".pt", ".eu", ".biz", ".es", ".org", ".net", ".de"]


def _stretches(runs):
    """Runs of digits glued from the left into the shortest stretches of nine
    digits or more, and the digits that are left."""
    for n in range(1, len(runs) + 1):
        stretch = "".join(runs[:n])
        if len(stretch) >= 9:
            more, rest = _stretches(runs[n:])
            return [stretch] + more, rest
    return [], "".join(runs)


def phones(text):
    """A number is a stretch; digits left at the end are a variant of the last
    number that ends with them. More than nine digits have a country's prefix."""
    numbers, rest = _stretches(re.findall("[0-9]+", text or ""))
    if numbers and rest:
        numbers.append(numbers[-1][:-len(rest)] + rest)
    return [f"+{n}" if len(n) > 9 else n for n in numbers]


def _domain(after):
    """Where a domain ends in the text after an @: behind the ending whose first
    place is furthest right (not at the very begin); 0 if there is none."""
    places = {e: after.find(e) for e in ENDS}
    furthest = max(places, key=places.get)
    return places[furthest] + len(furthest) if places[furthest] > 0 else 0


def _addresses(before, sides):
    """The addresses of the text ``before`` an @ and the texts on its other ``sides``."""
    if not sides:
        return []
    raw, rest = sides[0], sides[1:]
    after = "".join(raw.lower().replace("\t", " ").split(" "))
    end = _domain(after)
    if not end or end == len(after):
        # Nothing before the next @ can be a name: it is passed over.
        later = _addresses(rest[0], rest[1:]) if rest else []
    else:
        later = _addresses(after[end:], rest)
    name = re.sub(r"\A\W+", "", before.lower().replace(" ", "")).encode("ascii", "ignore").decode()
    return [f"{name}@{after[:end]}"] + later if end and name else later


def emails(text):
    first, *sides = (text or "").split("@")
    return _addresses(first, sides)


def repair_quotes(line, delim, quote):
    parts = line.split(quote)
    for i in range(1, len(parts) - 1, 2):
        parts[i] = parts[i].replace(delim, "")
    return quote.join(parts)


# The repair chain, from its definition: a row has a place, generated rows come
# after all others in the order they were made, and who shows a value first
# is the least (place, position) of its entity.
def _first(events):
    """{(entity, value): least event} of (entity, value, event) triples."""
    out = {}
    for entity, value, event in events:
        out[entity, value] = min(out.get((entity, value), event), event)
    return out


def _with(cells, i, value):
    return [*cells[:i], value, *cells[i + 1:]]


def _pulled(cells, spec):
    """The digit cells at the e-mail position that a too wide row can spare, and what stays."""
    at, spare = spec.email_pos, len(cells) - spec.width
    bare = [c.replace(" ", "") for c in cells[at:at + max(spare, 0)]]
    out = list(takewhile(lambda c: re.fullmatch("[0-9]+", c), bare))
    stay = cells[:at] + cells[at + len(out):]
    if spare > len(out) and "@" not in stay[at]:
        stay = _with(stay, at, stay[at].replace(" ", ""))
    return out, stay


def excess(rows, spec):
    wide = {o: _pulled(c, spec) for o, c in rows if len(c) > spec.width}
    shown = [(stay[spec.id_pos], n, (o, 0)) for o, (out, stay) in wide.items() for n in out]
    shown += [(stay[spec.id_pos], stay[spec.phone_pos], (o, 1)) for o, (_, stay) in wide.items() if stay[spec.phone_pos]]
    new = [((1, *o, i), _with(wide[o][1], spec.phone_pos, n)) for (_, num), (o, kind) in _first(shown).items() if kind == 0
           for i, n in enumerate(wide[o][0]) if n == num]
    return [(o, wide[o][1] if o in wide else c) for o, c in rows] + sorted(new)


def contacts(rows, at, find, spec, step, blank):
    found = {o: find(c[at]) for o, c in rows}
    rows = [(o, _with(c, at, found[o][0]) if found[o] else _with(c, at, "") if blank else c) for o, c in rows]
    shown = [(c[spec.id_pos], v, (o, i)) for o, c in rows if len(found[o]) > 1 for i, v in enumerate(found[o])]
    cells = dict(rows)
    new = [((step, *o, i), _with(cells[o], at, v)) for (_, v), (o, i) in _first(shown).items() if i]
    return rows + sorted(new)


def chain(lines, spec):
    """Whole file repair; ``lines`` excludes the header. Returns rows of cells."""
    d, name = spec.delimiter, spec.name_pos
    rows = [((0, i), repair_quotes(x, d, spec.quote).split(d)) for i, x in enumerate(lines, 1)]
    rows = excess(rows, spec)
    rows = contacts(rows, spec.phone_pos, phones, spec, 2, False)
    rows = contacts(rows, spec.email_pos, emails, spec, 3, True)
    out = [d.join(c).strip().split(d) for _, c in rows]
    split_name = lambda c: len(c) > spec.max_cells and c[name + 1] not in spec.content_after_name
    return [[*c[:name], " ".join(c[name:name + 2]), *c[name + 2:]] if split_name(c) else c for c in out]
