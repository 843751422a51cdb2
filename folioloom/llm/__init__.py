"""Operators that prepare text for training language models.

Nothing outside this subpackage imports it; the driver entry adds its queries when
the folder is present.
"""
