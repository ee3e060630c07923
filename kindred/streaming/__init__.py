"""Row-wise operators on streams.

Nothing here keeps state: filters, label and text expressions and the
prediction of a fitted line apply to a streaming DataFrame as they are.
"""
