"""Domain-intelligence engine on PySpark: zone, DNS, WHOIS, RDAP, traffic and ownership data as DataFrames."""
