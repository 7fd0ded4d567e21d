"""Operations of a training-data pipeline over ``documents`` and friends.

Nothing else in the library imports this subpackage; its queries are listed
in ``quaylake.llm.catalog``.
"""
