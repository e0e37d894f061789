"""Fixed values.

Everything in this module is a constant whose value decides results: language names,
marker strings, skip lists, the category table, bucket labels and the record type.
"""

# Languages of the corpus, in processing order.
LANGUAGES = (
    "c", "cpp", "c_sharp", "go", "java", "javascript",
    "python", "ruby", "scala", "typescript",
)

# Spelling variants of one language name.
LANGUAGE_ALIASES = {"csharp": "c_sharp", "c-sharp": "c_sharp"}

# Names accepted by the declared record schema.
DECLARED_LANGUAGES = (
    "c", "cpp", "csharp", "go", "java", "javascript",
    "python", "ruby", "scala", "typescript",
)

# Samples holding one of these are dropped.
DROP_MARKERS = (
    "<issue_start>", "<issue_comment>", "<issue_closed>",
    "<jupyter_start>", "<jupyter_text>", "<jupyter_code>", "<jupyter_output>",
    "<commit_before>", "<commit_msg>", "<commit_after>",
)

# Lines holding one of these are removed.
LINE_MARKERS = ("<reponame>", "<gh_stars>", "<filename>")

# Removed wherever it occurs.
END_MARKER = "<|endoftext|>"

# Columns not needed after filtering.
REPOSITORY_COLUMNS = (
    "max_stars_repo_path", "max_stars_repo_name", "max_stars_count", "id",
)

# Characters Python's str.strip() removes.
PYTHON_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)

# Histogram of line counts.
LINE_BUCKETS = (
    "0-100", "101-200", "201-300", "301-400", "401-500", "501-600",
    "601-700", "701-800", "801-900", "901-1000", "1000+",
)

# A node whose stripped text equals one of these is skipped.
SKIP_TEXTS = (
    "(", ")", "{", "}", "[", "]", ",", ";", ":", ".", "->", "::", "...", "|", "&",
    "def", "class", "function", "var", "let", "const",
    "public", "private", "protected", "static",
    "if", "else", "for", "while", "return",
    "import", "from", "as", "export", "package",
    "try", "catch", "finally", "throw", "raise",
    "new", "delete", "sizeof", "typeof", "async", "await", "yield",
    "then", "do", "end", "begin",
)

# A node of one of these types is skipped.
SKIP_TYPES = (
    "(", ")", "{", "}", "[", "]", ",", ";", ":", ".",
    "def", "class", "return", "if", "else", "elif", "for", "while",
    "import", "from", "as", "public", "private", "protected", "static",
    "const", "var", "let", "function", "try", "catch", "finally", "throw",
    "async", "await", "new", "delete",
    "comment", "string_content", "string_start", "string_end",
    "expression_statement", "block", "module", "dotted_name", "program",
    "block_comment", "class_body", '"', "string_fragment", "translation_unit",
    "compound_statement", "field_declaration_list", "compilation_unit",
    "declaration_list", "string_literal_content", "source_file",
    "interpreted_string_literal_content", "statement_block", "type_annotation",
    "/*", "template_body",
)

# A node of the first type below one of the parent types is skipped.
SKIP_UNDER_PARENT = (
    ("variable_declarator", ("variable_declaration", "lexical_declaration")),
    ("type_spec", ("type_declaration",)),
)

# Category of a node: the first row with a substring of the lower-cased type wins.
CATEGORIES = (
    ("declarations", "functions", ("function", "method", "def ", "func ")),
    ("declarations", "classes", ("class", "struct", "interface", "trait", "union")),
    ("declarations", "imports", ("import", "include", "using", "require")),
    ("declarations", "modules", ("module", "namespace", "package", "export")),
    ("declarations", "enums", ("enum", "enumeration")),
    ("declarations", "variables", ("declaration", "definition", "variable", "var ")),
    ("statements", "returns", ("return",)),
    ("statements", "conditionals", ("if", "switch", "case", "conditional")),
    ("statements", "loops", ("for", "while", "loop")),
    ("statements", "exceptions", ("try", "except", "catch", "finally", "throw", "raise")),
    ("statements", "assignments", ("assignment", "assign")),
    ("statements", "expressions", ("expression",)),
    ("expressions", "calls", ("call", "invocation")),
    ("expressions", "binary_operations", ("binary", "arithmetic", "operator")),
    ("expressions", "unary_operations", ("unary",)),
    ("expressions", "member_access", ("member", "field", "property", "access", "dot")),
    ("expressions", "identifiers", ("identifier", "name", "symbol")),
    ("expressions", "literals", ("literal", "string", "number", "integer", "float", "boolean")),
)

# Order of the category lists inside a record.
CATEGORY_FIELDS = {
    "declarations": ("functions", "variables", "classes", "imports", "modules", "enums"),
    "statements": ("expressions", "assignments", "loops", "conditionals", "returns", "exceptions"),
    "expressions": (
        "calls", "literals", "identifiers", "binary_operations", "unary_operations", "member_access",
    ),
}

# Graph colours of root and other nodes.
ROOT_COLOUR = "#00c2ff"
NODE_COLOUR = "#ffaa00"

# Tags that never open a level.
VOID_TAGS = (
    "area", "base", "br", "col", "embed", "hr", "img", "input",
    "link", "meta", "source", "track", "wbr",
)

# Type of one node and of one record.
POINT_TYPE = "struct<row:int,column:int>"
NODE_TYPE = (
    "struct<id:int,type:string,text:string,parent:int,children:array<int>,"
    f"start_point:{POINT_TYPE},end_point:{POINT_TYPE}>"
)
CATEGORY_TYPE = "struct<" + ",".join(
    f"{group}:struct<" + ",".join(f"{name}:array<int>" for name in names) + ">"
    for group, names in CATEGORY_FIELDS.items()
) + ">"
DECLARED_ENTRY_TYPE = "struct<node_id:int,universal_type:string,name:string,text_snippet:string>"
MAP_TYPE = (
    f"struct<function_declarations:array<{DECLARED_ENTRY_TYPE}>,"
    f"class_declarations:array<{DECLARED_ENTRY_TYPE}>,"
    "import_statements:array<struct<node_id:int,text:string>>>"
)
RECORD_TYPE = (
    "struct<language:string,success:boolean,"
    "metadata:struct<lines:int,avg_line_length:double,nodes:int,errors:int,"
    "source_hash:string,categorized_nodes:int>,"
    f"ast:struct<root:string,nodes:array<{NODE_TYPE}>>,"
    f"node_categories:{CATEGORY_TYPE},cross_language_map:{MAP_TYPE},"
    "original_source_code:string>"
)

# The declared schema of a record.
_WHOLE = {"type": "integer"}
_WHOLE_OR_NULL = {"type": ["integer", "null"]}
_STRING = {"type": "string"}
_STRING_OR_NULL = {"type": ["string", "null"]}
_BOOLEAN = {"type": "boolean"}
_POINT = {"type": "object", "properties": {"row": _WHOLE, "column": _WHOLE}}


def _list_of(items):
    return {"type": "array", "items": items}


def _object(properties, required=()):
    return {"type": "object", "required": list(required), "properties": properties}


NODE_SCHEMA = _object({
    "id": _WHOLE, "type": _STRING, "text": _STRING, "start_byte": _WHOLE, "end_byte": _WHOLE,
    "start_point": _POINT, "end_point": _POINT, "children": _list_of(_WHOLE), "parent": _WHOLE_OR_NULL,
    "field_name": _STRING_OR_NULL, "is_named": _BOOLEAN, "is_error": _BOOLEAN,
    "language_specific": {"type": "object", "additionalProperties": True},
}, required=("id", "type", "text"))
CATEGORY_SCHEMA = _object({
    "declarations": _object({n: _list_of(_WHOLE) for n in ("functions", "variables", "classes", "imports")}),
    "statements": _object({
        n: _list_of(_WHOLE) for n in ("expressions", "assignments", "loops", "conditionals", "returns")}),
    "expressions": _object({
        n: _list_of(_WHOLE) for n in ("calls", "literals", "identifiers", "binary_operations", "unary_operations")}),
})
MAP_SCHEMA = _object({
    "function_declarations": _list_of(_object({
        "node_id": _WHOLE, "universal_type": {**_STRING, "enum": ["function", "method", "constructor", "lambda"]},
        "name_node": _WHOLE_OR_NULL, "parameters_node": _WHOLE_OR_NULL,
        "return_type_node": _WHOLE_OR_NULL, "body_node": _WHOLE_OR_NULL})),
    "class_declarations": _list_of(_object({
        "node_id": _WHOLE, "universal_type": {**_STRING, "enum": ["class", "struct", "interface", "trait", "enum"]},
        "name_node": _WHOLE_OR_NULL, "body_node": _WHOLE_OR_NULL})),
    "import_statements": _list_of(_object({
        "node_id": _WHOLE, "module_path": _STRING_OR_NULL, "imported_items": _list_of(_STRING)})),
})
RECORD_SCHEMA = _object({
    "schema_version": _STRING,
    "language": {**_STRING, "enum": list(DECLARED_LANGUAGES)},
    "success": _BOOLEAN,
    "metadata": _object({
        "lines": _WHOLE, "avg_line_length": {"type": "number"}, "nodes": _WHOLE, "errors": _WHOLE, "source_hash": _STRING,
    }, required=("lines", "avg_line_length", "nodes", "errors")),
    "ast": _object({
        "root": _STRING, "nodes": _list_of(NODE_SCHEMA),
        "node_categories": CATEGORY_SCHEMA, "cross_language_map": MAP_SCHEMA,
    }, required=("root", "nodes")),
    "errors": _list_of(_object({"type": _STRING, "message": _STRING, "start_point": _POINT, "end_point": _POINT})),
    "source_context": _object({"original_source": _STRING}),
}, required=("language", "success", "metadata", "ast"))
