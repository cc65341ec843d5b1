"""Reading workbooks and finding the tables in their sheets."""
