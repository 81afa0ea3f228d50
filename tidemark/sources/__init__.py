"""Reading workbooks and tables, and writing warehouse tables."""
