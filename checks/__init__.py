"""One query per operator, and the SQL that states its result independently."""
