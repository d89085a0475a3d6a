"""Reading and writing of layer tables, rate payloads and JDBC targets."""
