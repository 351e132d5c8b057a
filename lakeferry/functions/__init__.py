"""Column expressions: type mapping, row normalising, JSON, XML, HTML and text helpers."""
