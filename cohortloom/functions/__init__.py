"""Column expressions as SQL text over column names.

Text goes into ``selectExpr``, ``where`` or ``F.expr`` and is parsed once on the JVM. The wide
plans here have hundreds of expressions; as Column objects each of their nodes would cost the
driver a round trip.
"""
