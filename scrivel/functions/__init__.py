"""Column -> Column expressions. Everything here stays in the JVM except the
rare-entity branch of :func:`scrivel.functions.text.decode_entities`."""
