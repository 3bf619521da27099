"""Column functions: everything here maps Columns to a Column and stays inside the JVM."""
