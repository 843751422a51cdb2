"""Column functions: text, HTML, metrics and catalogue expressions."""
