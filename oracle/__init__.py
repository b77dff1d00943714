"""Plain SQL that checks each query on a second engine, written apart from the library."""
