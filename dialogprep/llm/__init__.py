"""Operations of a large-scale training-data pipeline.

Each module holds one operator with its own interface; ``queries`` registers
one checkable query per operator. Nothing outside this package imports it.
"""
