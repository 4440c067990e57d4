"""Fixed values of the register: code labels and activity-code ranges."""

# Fixed values, as the register publishes them.
TIPO_SOCIO = {1: "PESSOA JURÍDICA", 2: "PESSOA FÍSICA", 3: "ESTRANGEIRO"}
PORTE_EMPRESA = {
    1: "NÃO INFORMADO",
    2: "MICRO EMPRESA",
    3: "EMPRESA DE PEQUENO PORTE",
    5: "DEMAIS",
}
MATRIZ_FILIAL = {1: "MATRIZ", 2: "FILIAL"}
# The job this library re-expresses never reaches FILIAL; kept for exact reproduction.
MATRIZ_FILIAL_AS_WRITTEN = {1: "MATRIZ"}
SITUACAO_CADASTRAL = {1: "NULA", 2: "ATIVA", 3: "SUSPENSA", 4: "INAPTA", 8: "BAIXADA"}

# Half-open activity-code ranges [low, high).
INDUSTRY = (500000, 3400000)
COMMERCE = (4500000, 4800000)
HIGHER_EDUCATION = (8530000, 8540000)

FOREIGN_STATE = "EX"
SMALL_FIRM = 3
STATUS_ACTIVE = 2
STATUS_CLOSED = 8
