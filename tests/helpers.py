"""Small MARC fixtures, written byte by byte and without the library."""


def marc21(number, provider=None, leader_code="a", extra=()):
    """One binary record: 001 and optionally 961 $d."""
    fields = [("001", str(number).encode() + b"\x1e")]
    for tag, body in extra:
        fields.append((tag, body + b"\x1e"))
    if provider is not None:
        fields.append(("961", b"  \x1fd" + provider.encode() + b"\x1e"))
    directory, data = b"", b""
    for tag, body in fields:
        directory += f"{tag}{len(body):04d}{len(data):05d}".encode()
        data += body
    base = 24 + len(directory) + 1
    total = base + len(data) + 1
    leader = f"{total:05d}nam {leader_code}22{base:05d}   4500".encode()
    return leader + directory + b"\x1e" + data + b"\x1d"


def xml_field(tag, ind1, ind2, *pairs):
    """One data field of (code, value) pairs."""
    inner = "".join(f'<subfield code="{code}">{value}</subfield>' for code, value in pairs)
    return f'<datafield tag="{tag}" ind1="{ind1}" ind2="{ind2}">{inner}</datafield>'


def xml_element(controls, fields):
    """One record of (tag, value) control fields and data fields."""
    named = "".join(f'<controlfield tag="{tag}">{value}</controlfield>' for tag, value in controls)
    return f"<record>{named}{''.join(fields)}</record>"


def xml_record(number, kind="Image", urls=("https://pictures.example.net/a/1.jpg",), ind1="4", ind2=" "):
    """A catalog record: links first, then its kind and local id."""
    fields = [xml_field("856", ind1, ind2, ("u", url)) for url in urls]
    if kind is not None:
        fields.append(xml_field("336", " ", " ", ("a", kind)))
    fields.append(xml_field("035", " ", " ", ("a", "local")))
    return xml_element([] if number is None else [("001", number)], fields)


def collection(*records):
    return (
        '<?xml version="1.0" encoding="UTF-8"?>\n'
        '<collection xmlns="http://www.loc.gov/MARC21/slim">\n'
        + "\n".join(records)
        + "\n</collection>\n"
    )
