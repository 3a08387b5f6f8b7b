"""Training-data operators over `documents` (see the README, section "Training-data operators").

Nothing outside this subpackage imports it. Operators take a DataFrame with an id and a text
column and use only these two, so extra columns never clash with their output.
"""
